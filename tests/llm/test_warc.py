import hashlib
import random

import pytest

from folioscope.llm import warc


def want(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        to = first.get(p)
        again = len(p) >= 100 and to is not None and to != i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def pages():
    rng = random.Random(1)
    fake = warc._record(77, "http://fake", b"fake payload " * 20, "0" * 64, None).decode()
    rows = [(k, f"http://x/{k}", "é" * rng.randint(0, 400)) for k in range(120)]
    rows += [(200, "http://a b\r\nX: y", fake), (201, None, fake * 3), (198, "http://x/a%20b%zz%", "q"), (197, "é\x7f\t", "q"), (202, "u", "WARC/1.0\r\nContent-Length: 5\r\n\r\n" + "x" * 99), (203, "u", None), (204, "u", ""), (205, "u", "z" * 99), (206, "u", "z" * 99)]
    rows += [(300, "u", "same " * 50), (299, "u", "same " * 50), (301, "u", "same " * 50), (301, "u", "same " * 50), (None, "u", "same " * 50), (207, "u", "WARC/1.0\r\n" * 500)]
    return rows


@pytest.mark.parametrize("width", [200, 1000, 64 << 20])
def test_round_trip(spark, width):
    rows = pages()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").coalesce(2)
    manifest = warc.write_archives(df)
    got = warc.read_archives(manifest, width)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*names).collect()), key=str) == want(rows)
    assert sorted((str(r["page_id"]), str(r["url"])) for r in got.collect()) == sorted((str(i), str(u)) for i, u, _ in rows)


def test_a_broken_file_is_an_error(spark, tmp_path):
    good = warc._record(1, "u", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None)
    (tmp_path / "a.warc").write_bytes(good + b"garbage" + good)
    manifest = spark.createDataFrame([(f"file://{tmp_path}/a.warc", 2 * len(good) + 7)], "file string, size long")
    with pytest.raises(Exception, match="no record at"):
        warc.read_archives(manifest).collect()


def test_empty(spark):
    manifest = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archives(manifest).count() == 0
