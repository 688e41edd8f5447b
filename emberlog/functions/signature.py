"""Signatures, endpoint templates, error kinds and other values read out of log lines.

The fixed patterns are plain regular expressions without lookaround or back references.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from .clock import col

# The three-part signature grammar, and the same grammar at the head of a raw line.
SIGNATURE_PATTERN = r"^\[[^\]]+\]:\[[^\]]+\]:\[[^\]]+\]$"
SIGNATURE_PREFIX = r"^(\[[^\]]+\]:\[[^\]]+\]:\[[^\]]+\])[ ]*"
FRAME_PATTERN = r"(?:^|[ \t\r\n])at ([A-Za-z0-9_.$<>]+)\("
CALL_PATTERN = r"Call to ([A-Za-z0-9_]+(?:\.[A-Za-z0-9_]+)+) "
SERVICE_SUFFIX = r"-api$"
EXCEPTION_PATTERN = r"([A-Za-z0-9_]+(?:Exception|Error))"

# Placeholders for the parts of a message that change from line to line, in order. The last
# entry is a text every match contains; looking for it first spares most messages the pattern.
MASKS = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<email>", "@"),
    (r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", "<guid>", "-"),
    (r"0x[0-9a-fA-F]+", "<hex>", "0x"),
    (r"[0-9]+", "<num>", ""),
)

# Error kinds, in the order they are tried. Substrings are matched in lower case.
ERROR_KINDS = (
    ("TIMEOUT", ("timeout", "timed out", "deadline exceeded")),
    ("CONNECTION", ("connection reset", "connection refused", "broken pipe")),
    ("THROTTLED", ("throttl", "rate limit", "too many requests")),
    ("AUTH", ("unauthorized", "forbidden", "authentication")),
    ("NOT_FOUND", ("not found", "no such")),
    ("VALIDATION", ("validation", "missing field", "invalid")),
    ("DEPENDENCY_FAILURE", ("bad gateway", "service unavailable", "upstream")),
)
ERROR_CODES = {408: "TIMEOUT", 504: "TIMEOUT", 429: "THROTTLED", 401: "AUTH", 403: "AUTH", 404: "NOT_FOUND",
               400: "VALIDATION", 422: "VALIDATION", 502: "DEPENDENCY_FAILURE", 503: "DEPENDENCY_FAILURE"}


def signature(service: Column | str, action: Column | str, result: Column | str) -> Column:
    """``[SERVICE]:[ACTION]:[RESULT]``."""
    return F.concat(F.lit("["), col(service), F.lit("]:["), col(action), F.lit("]:["), col(result), F.lit("]"))


def valid_signature(c: Column | str) -> Column:
    return col(c).rlike(SIGNATURE_PATTERN)


def signature_prefix(line: Column | str) -> Column:
    """The signature a raw line starts with, or an empty string."""
    return F.regexp_extract(col(line), SIGNATURE_PREFIX, 1)


def payload_rest(line: Column | str) -> Column:
    """What follows the signature prefix of a raw line; the whole line when there is none."""
    return F.regexp_replace(col(line), SIGNATURE_PREFIX, "")


def mask_tokens(text: Column | str, masks: Sequence[tuple[str, str, str]] = MASKS) -> Column:
    """Put placeholders in place of addresses, identifiers and numbers."""
    out = col(text)
    for pattern, placeholder, sign in masks:
        masked = F.regexp_replace(out, pattern, placeholder)
        out = F.when(F.contains(out, F.lit(sign)), masked).otherwise(out) if sign else masked
    return out


def endpoint_template(url: Column | str) -> Column:
    """Path of a URL or path, without query and fragment, each all-digit segment turned into ``*``."""
    path = F.regexp_extract(col(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(path, r"/[0-9]+(?=/|\.|$)", "/*"), "^$", "/")


def status_class(status: Column | str) -> Column:
    """``5xx`` for 502."""
    return F.concat(F.floor(col(status) / 100).cast("string"), F.lit("xx"))


def exception_class(text: Column | str) -> Column:
    """First exception class named in the text, or null."""
    found = F.regexp_extract(col(text), EXCEPTION_PATTERN, 1)
    return F.when(found != "", found)


def called_operation(text: Column | str) -> Column:
    """The operation a message says was called, ``Target.method``, or null."""
    found = F.regexp_extract(col(text), CALL_PATTERN, 1)
    return F.when(found != "", found)


def service_name(service: Column | str) -> Column:
    """The service as signatures name it: ``ORDERS`` for orders-api."""
    return F.upper(F.regexp_replace(col(service), SERVICE_SUFFIX, ""))


def top_frame(text: Column | str) -> Column:
    """The first call of a stack trace in the text, ``package.Class.method``, or null."""
    found = F.regexp_extract(col(text), FRAME_PATTERN, 1)
    return F.when(found != "", found)


def error_kind(text: Column | str, exception: Column | str | None = None, status: Column | str | None = None,
               exceptions: Mapping[str, str] | None = None) -> Column:
    """Coarse category of an error: by exception class, then by substring, then by code; first match wins.

    Null stands for a row with no sign of an error; UNEXPECTED for an exception or a 5xx nothing else explains.
    """
    lower = F.lower(col(text))
    found: list[tuple[Column, str]] = []
    if exception is not None:
        for name, kind in (exceptions or {}).items():
            found.append((col(exception) == name, kind))
    for kind, words in ERROR_KINDS:
        found.append((reduce(lambda a, b: a | b, [F.contains(lower, F.lit(w)) for w in words]), kind))
    if status is not None:
        for kind in dict.fromkeys(ERROR_CODES.values()):
            found.append((col(status).isin([c for c, k in ERROR_CODES.items() if k == kind]), kind))
        found.append((col(status) >= 500, "UNEXPECTED"))
    if exception is not None:
        found.append((col(exception).isNotNull(), "UNEXPECTED"))
    chain = F.when(found[0][0], found[0][1])
    for cond, kind in found[1:]:
        chain = chain.when(cond, kind)
    return chain


def outcome(status: Column | str, retried: Column | None = None, cancelled: Column | None = None) -> Column:
    """SUCCESS, FAIL, RETRY or CANCELLED for jobs and calls. RETRY comes from an explicit column only."""
    status = col(status)
    chain = F.when(cancelled if cancelled is not None else status == 499, "CANCELLED")
    if retried is not None:
        chain = chain.when(retried, "RETRY")
    return chain.when(status >= 400, "FAIL").otherwise("SUCCESS")
