import pytest
from pyspark.sql import functions as F

from folioscope.functions import text as T
from folioscope.functions import vectors as V


def one(spark, column, **values):
    names = list(values)
    schema = ", ".join(f"{k} {'int' if isinstance(v, int) else 'array<double>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values[k] for k in names)], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [("  a \t b\n", "a b"), ("a , b ; c : d ) .", "a, b; c: d)."), ("a b c\x1cd", "a b c d"), ("", ""), (None, None), (" . ", "."), ("é  É", "é É")],
)
def test_clean_text(spark, text, want):
    assert one(spark, T.clean_text(F.col("t")), t=text) == want


def test_text_hash_ignores_case_and_space(spark):
    a, b = (one(spark, T.text_hash(F.col("t")), t=t) for t in ("A  b .", "a b."))
    assert a == b
    assert one(spark, T.raw_hash(F.col("t")), t="A") != one(spark, T.raw_hash(F.col("t")), t="a")


@pytest.mark.parametrize("text, want", [("", 1), (None, 1), ("a b c d e", 3), (" ".join("x" * 130), 100)])
def test_token_count(spark, text, want):
    assert one(spark, T.token_count(F.col("t")), t=text) == want


@pytest.mark.parametrize("text, n, want", [("a  b", 10, "a b"), ("abcdef ghij", 10, "abcdef..."), (None, 5, ""), ("abcde", 5, "abcde"), ("abcdef", 5, "ab...")])
def test_snippet(spark, text, n, want):
    assert one(spark, T.snippet(F.col("t"), n), t=text) == want


def test_tags(spark):
    assert one(spark, T.tags_removed(F.col("t")), t="a<b>c</b>&amp;") == "ac&amp;"
    assert one(spark, T.tags_spaced(F.col("t")), t="a<b>c</b>  d") == "a c d"


def test_error_page(spark):
    assert one(spark, T.is_error_page(F.col("t")), t="x Page Not Found") is True
    assert one(spark, T.is_error_page(F.col("t")), t="x" * 2048 + "Page Not Found") is False
    assert one(spark, T.is_error_page(F.col("t")), t=None) is False


def test_bill_ids(spark):
    build = T.build_bill_id(F.col("a"), F.col("b"), F.col("c"))
    assert one(spark, build, a="HR", b="42", c="119") == "hr42-119"
    assert one(spark, build, a="hr", b="", c="119") is None
    assert tuple(one(spark, T.parse_bill_id(F.col("t")), t="HR42-119")) == ("hr", "42", 119)
    assert one(spark, T.parse_bill_id(F.col("t")), t="hr42") is None


@pytest.mark.parametrize(
    "status, kind, want",
    [("ENACTED:SIGNED", "hr", "enr eah eh ih"), ("PASS_OVER:SENATE", "s", "es eas cps is"), ("REPORTED", "sres", "rs rds rfs is"), ("x", "hr", "enr eh rh ih"), (None, "s", "enr es rs is"), ("INTRODUCED", "zz", "is")],
)
def test_version_choice(spark, status, kind, want):
    assert one(spark, T.version_choice(F.col("s"), F.col("k")), s=status, k=kind) == want.split()


def test_version_rank(spark):
    assert [one(spark, T.ranked(F.col("v"), T.VERSION_RANKS), v=v) for v in ("ENR", "ih", "zz", None)] == [0, 5, 99, 99]


@pytest.mark.parametrize(
    "q, s, want",
    [("On passage", "On passage of the bill", ("", "On passage of the bill")), ("On passage of", "on  Passage", ("On passage of", "")), ("a", "b", ("a", "b")), ("", "b", ("", "b")), (None, None, ("", "")), ("x", "x", ("x", ""))],
)
def test_vote_pair(spark, q, s, want):
    assert tuple(one(spark, T.vote_pair(F.col("q"), F.col("s")), q=q, s=s)) == want


def test_vote_text(spark):
    prefix = T.vote_prefix(F.lit("h1"), F.lit("H"), F.lit("2024-01-02T03:04:05-05:00"), F.lit("passage"), F.lit("On passage"))
    narrative = T.vote_narrative(F.lit("Q"), F.lit(""), F.lit("Passed"), F.lit("hr1-119"))
    assert one(spark, T.vote_text(prefix, narrative), t="") == "[Vote h1, House, 2024-01-02] passage: On passage Question: Q Result: Passed Related bill: hr1-119"
    assert one(spark, T.vote_text(prefix, F.lit("")), t="") == "[Vote h1, House, 2024-01-02] passage: On passage"
    assert [one(spark, T.chamber_name(F.col("c")), c=c) for c in ("h", "S ", "x", None)] == ["House", "Senate", "X", "Unknown chamber"]


def test_source_hash_keeps_empty_parts(spark):
    import hashlib

    assert one(spark, T.source_hash(F.col("a"), F.col("b"), F.lit(0)), a="x", b=None) == hashlib.sha256(b"x||0").hexdigest()


def test_safe_values(spark):
    assert one(spark, T.safe_int(F.col("t")), t="x") == 0 and one(spark, T.safe_int(F.col("t")), t="7") == 7
    assert one(spark, T.parsed_timestamp(F.col("t")), t="nonsense") is None
    assert one(spark, T.parsed_timestamp(F.col("t")), t="2024-01-02T03:04:05-05:00").hour == 8


def test_section_path_and_identity(spark):
    assert one(spark, T.section_path(F.lit(""), F.lit("")), t="") is None and one(spark, T.section_path(F.lit("1"), F.lit("H")), t="") == "1 H"
    ident = T.chunk_identity(F.col("s"), F.col("d"), F.col("e"), F.lit(2), F.lit("hr1"), F.lit("3"))
    assert one(spark, ident, s="h", d="", e="") == "h|h" and one(spark, ident, s="", d="a", e="b") == "d|a|b|2" and one(spark, ident, s=None, d="a", e="") == "b|hr1|3|2"


def test_cosine(spark):
    assert one(spark, V.cosine_similarity(F.col("v"), [1.0, 0.0]), v=[1.0, 1.0]) == pytest.approx(0.5**0.5)
    assert one(spark, V.cosine_similarity(F.col("v"), [1.0, 0.0]), v=[0.0, 0.0]) is None
    assert one(spark, V.cosine_similarity(F.col("v"), [0.0, 0.0]), v=[1.0, 0.0]) is None
    assert one(spark, V.cosine_similarity(F.col("v"), [1.0]), v=[1.0, 0.0]) is None


def test_axis_embedding(spark):
    e = V.axis_embedding(F.col("t"), [("broadband", "rural"), ("water",)], 3)
    assert [one(spark, e, t=t) for t in ("Rural roads", "clean WATER", "x", None)] == [[1, 0, 0], [0, 1, 0], [0, 0, 0], [0, 0, 0]]


def test_hits_and_context(spark):
    line = T.hit_line(F.lit(0.5), F.lit("hr1"), F.lit(""), F.lit(None).cast("string"), F.lit("T"), F.lit("a  b"), 10)
    assert one(spark, line, t="") == "[0.5000] hr1 §? — (no header) | T\na b"
    assert one(spark, T.context_block(F.lit(1), [("Bill", F.lit("x")), ("Date", F.lit(""))]), t="") == "Result 1\nBill: x\nDate: —"
