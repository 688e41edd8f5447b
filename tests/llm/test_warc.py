import gzip
import hashlib
import random

from emberlog.llm import warc as W


def member(page, payload, kind="response", refers=None):
    digest = hashlib.sha256(payload).hexdigest()
    return gzip.compress(W.record_bytes(kind, page, f"http://x/{page}", payload, digest, len(payload), refers), 6, mtime=0)


def found(data):
    return [(a, b, None if r is None else [int(x.headers["page-id"]) for x in r]) for a, b, r in W.salvage(data)]


def test_whole_archive_has_no_gaps():
    parts = [member(i, b"payload %d " % i * 50) for i in range(5)] + [gzip.compress(b"")]
    at, want = 0, []
    for i, p in enumerate(parts):
        want.append((at, at + len(p), [i] if i < 5 else []))
        at += len(p)
    assert found(b"".join(parts)) == want


def test_every_damage_leaves_the_other_records():
    rng = random.Random(4)
    parts = [member(i, bytes(rng.choices(b"<p>abc WARC/1.1\r\n\x1f\x8b\x08", k=400))) for i in range(6)]
    starts = [sum(map(len, parts[:i])) for i in range(7)]
    whole = b"".join(parts)
    for _ in range(60):
        hurt = bytearray(whole)
        which = rng.randrange(6)
        place = rng.randrange(starts[which] + 12, starts[which + 1])
        hurt[place] ^= rng.randrange(1, 256)
        got = found(bytes(hurt))
        assert [r for _, _, r in got if r] == [[i] for i in range(6) if i != which]
        assert (starts[which], starts[which + 1], None) in got
    cut = whole[:starts[2] + 30] + whole[starts[4]:] + b"\x1f\x8b\x08 cut"
    got = found(cut)
    assert [r for _, _, r in got if r] == [[0], [1], [4], [5]] and sum(r is None for _, _, r in got) == 2


def test_plain_records_and_noise():
    plain = [gzip.decompress(member(i, b"text %d\r\n\r\nWARC/1.1\r\n" % i)) for i in range(4)]
    bad = plain[1].replace(b"text 1", b"text 9")
    data = b"noise" + plain[0] + bad + b"\n\n" + plain[2] + member(7, b"zipped") + plain[3][:-7]
    got = found(data)
    assert [r for _, _, r in got if r] == [[0], [2], [7]]
    assert [(a, b) for a, b, r in got if r is None] == [
        (0, 5), (5 + len(plain[0]), 5 + len(plain[0]) + len(bad) + 2), (len(data) - len(plain[3]) + 7, len(data))]


def test_archives_of_odd_pages(spark, tmp_path):
    long = "<p>ü</p>" * 40
    rows = [(3, "http://a b\r\n", long), (1, None, long), (2, "u", "short"), (4, "u", "short"), (5, "u", None), (6, "u", ""), (None, "n", long),
            (1, None, long), (None, "m", "other " * 30), (9, "WARC/1.1", "WARC/1.1\r\n\r\n" * 20)]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, length int, digest string")
    W.write_archives(pages, f"{tmp_path}/a")
    got = W.read_archives(spark, f"{tmp_path}/a").where("kind <> 'gap' OR past - first > 0").collect()
    assert all(r.kind != "gap" for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    assert [(r.kind, r.refers_to, r.payload_bytes) for r in by[3]] == [("revisit", 1, len(long.encode()))]
    assert [r.kind for r in by[1]] == ["response", "response"] and bytes(by[1][0].payload).decode() == long
    assert [(r.kind, bytes(r.payload)) for k in (2, 4, 5, 6) for r in by[k]] == [("response", b"short")] * 2 + [("response", b"")] * 2
    assert sorted((r.kind, r.refers_to, r.payload_bytes) for r in by[None]) == [("response", None, 180), ("revisit", 1, len(long.encode()))]
    assert len(got) == len(rows) and by[3][0].url == "http://a%20b%0D%0A"
    W.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert W.read_archives(spark, f"{tmp_path}/none").collect() == []


def bundled(pages, hurt=None, change=None):
    """One member of several records; ``hurt`` flips a payload byte of that record before, ``change`` a byte of the member after compression."""
    raw = [gzip.decompress(member(i, b"payload %04d " % i * 40)) for i in pages]
    if hurt is not None:
        raw[hurt] = raw[hurt].replace(b"payload %04d " % pages[hurt], b"Payload %04d " % pages[hurt], 1)
    out = bytearray(gzip.compress(b"".join(raw), 6, mtime=0))
    if change is not None:
        out[change] ^= 0x55
    return raw, bytes(out)


def inside(data):
    return [(a, b, [int(x.headers["page-id"]) if isinstance(x, W.Record) else (x.first, x.past) for x in r] if r is not None else None) for a, b, r in W.salvage(data)]


def test_records_around_a_damaged_one_in_the_same_member():
    raw, data = bundled([1, 2, 3], hurt=1)
    gap = (len(raw[0]), len(raw[0]) + len(raw[1]))
    before, after = member(8, b"x" * 200), member(9, b"y" * 200)
    got = inside(before + data + after)
    end = len(before) + len(data)
    assert got == [(0, len(before), [8]), (len(before), end, [1, gap, 3]), (end, end + len(after), [9])]
    raw, data = bundled([1, 2, 3], hurt=0)
    assert inside(data) == [(0, len(data), [(0, len(raw[0])), 2, 3])]


def test_cut_and_unplaced_damage():
    rng = random.Random(6)
    raw = [gzip.decompress(member(i, bytes(rng.choices(b"abcdefgh<>", k=3000)))) for i in range(3)]
    whole = gzip.compress(b"".join(raw), 6, mtime=0)
    # Cut in the third record: the two before it stand, as their digests hold.
    cut = inside(whole[:-600] + member(9, b"y" * 200))
    assert [r for _, _, records in cut if records for r in records if isinstance(r, int)] == [0, 1, 9]
    assert sum(isinstance(r, tuple) for _, _, records in cut if records for r in records) == 1
    # A wrong checksum with nothing wrong inside has no place: the member is a gap as a whole.
    assert inside(whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:]) == [(0, len(whole), None)]
    # Any flipped byte loses at most the member, and never yields a payload that was not there.
    payloads = {W.parse(r, 0)[0].payload for r in raw}
    for _ in range(60):
        hurt = bytearray(whole)
        hurt[rng.randrange(12, len(whole))] ^= rng.randrange(1, 256)
        got = list(W.salvage(bytes(hurt)))
        assert {r.payload for _, _, rs in got for r in rs or () if isinstance(r, W.Record)} <= payloads


def test_headers_from_elsewhere(spark, tmp_path):
    def foreign(kind, *lines):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + (b"hello" if kind == "response" else b"")
        head = ["WARC/1.0", f"WARC-Type: {kind}", "Content-Type: application/http", f"Content-Length: {len(block)}", *lines]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    odd = [foreign("response", "Page-ID: abc"), foreign("response", "Page-ID: 99999999999999999999"), foreign("revisit", "WARC-Payload-Length: many"),
           foreign("revisit", "WARC-Payload-Digest: sha1:ABC", "Refers-To-Page-ID: -", "Page-ID: -7"), foreign("metadata")]
    raw, hurt = bundled([1, 2], hurt=1)
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(gzip.compress(b"".join(odd)) + hurt)
    got = W.read_archives(spark, f"{tmp_path}/a").collect()
    assert [(r.kind, r.page_id, r.payload_bytes, r.payload_digest is None, r.refers_to) for r in got[:5]] == [
        ("response", None, 5, False, None), ("response", None, 5, False, None), ("revisit", None, None, True, None),
        ("revisit", -7, None, True, None), ("metadata", None, None, True, None)]
    assert [(r.kind, r.page_id, r.inner_first, r.inner_past) for r in got[5:]] == [("response", 1, None, None), ("gap", None, len(raw[0]), len(raw[0]) + len(raw[1]))]


def test_revisits_name_the_record_they_refer_to():
    first, again = [W.parse(gzip.decompress(m), 0)[0].headers for m in (member(1, b"p" * 200), member(2, b"p" * 200, "revisit", 1))]
    assert again["warc-refers-to"] == first["warc-record-id"] != again["warc-record-id"]
