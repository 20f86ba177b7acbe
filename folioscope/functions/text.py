"""Scalar text functions as Columns: cleaning, hashing, counting, identifiers, display.

White space is Python's Unicode set: ``(?U)[\\s\\x1C-\\x1F]`` in Java, which has fast predicates for it. Engines that
disagree on ``\\s`` get ``SQL_SPACE``, the same set spelled out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: To be used under the flag U.
SPACE = r"[\s\x1C-\x1F]"
SPACES = "(?U)" + SPACE + "+"
WORD = r"(?U)[^\s\x1C-\x1F]+"
SQL_SPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
SQL_WORD = SQL_SPACE.replace("[", "[^", 1) + "+"

TYPE_NAMES = dict(s="S.", hr="H.R.") | {c + k: c.upper() + "." + n for c in "hs" for k, n in (("res", "Res."), ("jres", "J.Res."), ("conres", "Con.Res."))}
#: Codes of one rank stand together, the most final first.
VERSION_RANKS = {code: rank for rank, codes in enumerate("enr|eah eas|eh es|rh rs|rds rfh rfs|ih is".split("|")) for code in codes.split()}
BOILERPLATE = tuple("definitions|effective date|effective dates|severability clause|severability|table of contents|short title; table of contents|short title".split("|"))
#: Which version codes to try, by the first status word that the status contains.
VERSIONS_BY_STATUS = tuple(
    (marks, tuple(codes.split()))
    for marks, codes in (
        (("ENACTED", "SIGNED"), "enr eas eah es eh ih is"),
        (("PASS",), "es eh eas eah cps cph ih is"),
        (("REPORTED",), "rs rh rds rfh rfs ih is"),
        (("REFERRED",), "rfh rfs ih is"),
        (("INTRODUCED",), "ih is"),
    )
)
FALLBACK_VERSIONS = tuple("enr eh es rh rs ih is".split())
#: Literals of pages that say not found with status 200.
ERROR_PAGE_MARKS = tuple("Page Not Found|page you requested cannot be found|govinfo.gov/error".split("|"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used: it is bound as a lambda variable."""
    return F.transform(F.array(value), use)[0]


#: What printable ASCII that is clean already does not contain: the test is far cheaper than the replacements.
_UNCLEAN = r"[^ -~]|  | [.,;:)]|^ | $"


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def clean_text(c: Column) -> Column:
    """White space collapsed, none before ``. , ; : )``, trimmed."""
    return F.when(c.rlike(_UNCLEAN), F.trim(F.regexp_replace(F.regexp_replace(c, SPACES, " "), r" ([.,;:)])", "$1"))).otherwise(c)


def normalized(c: Column) -> Column:
    """Cleaned and lower-cased: what exact-duplicate hashes are taken of."""
    return F.lower(clean_text(c))


def text_hash(c: Column) -> Column:
    """sha256 of the normalised text."""
    return F.sha2(normalized(c), 256)


def raw_hash(c: Column) -> Column:
    """sha256 of the text as it is: for change detection."""
    return F.sha2(c, 256)


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0))


def token_count(c: Column) -> Column:
    """Estimated tokens: words / 1.3, at least 1."""
    return tokens_of(word_count(c))


def tokens_of(n: Column) -> Column:
    """``token_count`` from a number of words."""
    return F.greatest(F.lit(1), F.floor(n / F.lit(1.3)).cast("int"))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(" + WORD + ")"), 1)


def snippet(c: Column, n: int) -> Column:
    """At most ``n`` characters of the collapsed text, ended by ``...`` where cut."""
    return let(collapsed(F.coalesce(c, F.lit(""))), lambda t: F.when(F.length(t) <= n, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, n - 3)), F.lit("..."))))


def tags_removed(c: Column) -> Column:
    """Tags become nothing; references stay."""
    return F.regexp_replace(c, "<[^>]+>", "")


def tags_spaced(c: Column) -> Column:
    """Tags become spaces, then white space is collapsed: the change detector's text."""
    return collapsed(F.regexp_replace(c, "<[^>]+>", " "))


def is_error_page(c: Column) -> Column:
    """A page of status 200 that says not found, by marks in its first 2,048 characters."""
    head = F.substring(c, 1, 2048)
    out = F.lit(False)
    for mark in ERROR_PAGE_MARKS:
        out = out | F.contains(head, F.lit(mark))
    return F.coalesce(out, F.lit(False))


def safe_int(c: Column, default: int = 0) -> Column:
    return F.coalesce(c.cast("string").try_cast("int"), F.lit(default))


def text_value(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def parsed_timestamp(c: Column) -> Column:
    """An ISO timestamp, or null where it can't be parsed."""
    return F.try_to_timestamp(c)


def ranked(c: Column, ranks: dict[str, int], unknown: int = 99) -> Column:
    """A code's rank, by its lower-case form; unknown codes come last."""
    table = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.coalesce(table[F.lower(F.coalesce(c, F.lit("")))], F.lit(unknown))


def alias_key(version: Column, bill_id: Column, enum: Column, header: Column, ranks: dict[str, int] = VERSION_RANKS) -> Column:
    """Order of aliases: version rank, version, id, section number, header."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(ranked(version, ranks).alias("r"), F.lower(empty(version)).alias("v"), bill_id.alias("b"), empty(enum).alias("e"), empty(header).alias("h"))


def bill_order_key(congress: Column, kind: Column, number: Column, bill_id: Column) -> Column:
    """Order of bills: congress, type, number (numeric ones first, by value), id."""
    n = number.try_cast("bigint")
    return F.struct(congress.alias("c"), kind.alias("t"), n.isNull().alias("x"), n.alias("n"), number.alias("s"), bill_id.alias("b"))


def build_bill_id(kind: Column, number: Column, congress: Column) -> Column:
    """``{type}{number}-{congress}``; null if a part is missing."""
    part = lambda c: F.nullif(F.trim(c.cast("string")), F.lit(""))
    return F.concat(F.lower(part(kind)), part(number), F.lit("-"), part(congress))


def parse_bill_id(c: Column) -> Column:
    """struct(type, number, congress), or null if the id is malformed."""
    t, pattern = F.lower(F.trim(c)), r"^([a-z]+)([0-9]+)-([0-9]+)$"
    get = lambda k: F.regexp_extract(t, pattern, k)
    return F.when(t.rlike(pattern), F.struct(get(1).alias("type"), get(2).alias("number"), get(3).cast("int").alias("congress")))


def version_choice(status: Column, kind: Column) -> Column:
    """Version codes to try: those of the bill's chamber, and ``enr``; all, if none is."""
    s = F.upper(F.coalesce(status, F.lit("")))
    codes = F.array(*map(F.lit, FALLBACK_VERSIONS))
    for marks, versions in reversed(VERSIONS_BY_STATUS):
        hit = F.lit(False)
        for m in marks:
            hit = hit | F.contains(s, F.lit(m))
        codes = F.when(hit, F.array(*map(F.lit, versions))).otherwise(codes)
    chamber = F.when(kind.isin(*"hconres hjres hres hr".split()), "h").otherwise("s")
    own = F.filter(codes, lambda v: (v == "enr") | v.endswith(chamber))
    return F.when(F.size(own) > 0, own).otherwise(codes)


def content_url(base: str, congress: Column, kind: Column, number: Column, version: Column, subdir: str = "xml", ext: str = "xml") -> Column:
    package = F.concat(F.lit("BILLS-"), congress.cast("string"), kind, number, version)
    return F.concat(F.lit(f"{base}/"), package, F.lit(f"/{subdir}/"), package, F.lit(f".{ext}"))


def section_path(enum: Column, header: Column) -> Column:
    """Number and header joined by a space; null if both are empty."""
    return F.nullif(F.concat_ws(" ", F.nullif(enum, F.lit("")), F.nullif(header, F.lit(""))), F.lit(""))


def chunk_prefix(kind: Column, number: Column, congress: Column, enum: Column, header: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    head = F.concat(F.lit("["), F.coalesce(names[kind], F.upper(kind)), F.lit(" "), number.cast("string"), F.lit(", "), congress.cast("string"), F.lit("th Congress]"))
    enum, header = F.coalesce(enum, F.lit("")), F.coalesce(header, F.lit(""))
    return (
        F.when(enum != "", F.concat(head, F.lit(" Section "), enum, F.lit(": "), header, F.lit(" —")))
        .when(header != "", F.concat(head, F.lit(" "), header, F.lit(" —")))
        .otherwise(F.concat(head, F.lit(" —")))
    )


def chamber_name(c: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t == "h", "House").when(t == "s", "Senate").when(t == "", "Unknown chamber").otherwise(F.upper(t))


def vote_pair(question: Column, subject: Column) -> Column:
    """struct(question, subject): where one, normalised, begins with the other, only the longer stays."""
    q, s = (clean_text(F.coalesce(c, F.lit(""))) for c in (question, subject))

    def pick(p: Column) -> Column:
        both = (p["q"] != "") & (p["s"] != "") & (F.startswith(p["ql"], p["sl"]) | F.startswith(p["sl"], p["ql"]))
        first = F.length(p["q"]) >= F.length(p["s"])
        return F.struct(F.when(both & ~first, "").otherwise(p["q"]).alias("question"), F.when(both & first, "").otherwise(p["s"]).alias("subject"))

    return let(let(F.struct(q.alias("q"), s.alias("s")), lambda p: F.struct(p["q"].alias("q"), p["s"].alias("s"), F.lower(p["q"]).alias("ql"), F.lower(p["s"]).alias("sl"))), pick)


def vote_prefix(vote_id: Column, chamber: Column, date: Column, category: Column, kind: Column) -> Column:
    c = lambda x: clean_text(F.coalesce(x, F.lit("")))
    day = F.substring(F.trim(F.coalesce(date, F.lit(""))), 1, 10)
    return clean_text(F.concat(F.lit("[Vote "), F.trim(F.coalesce(vote_id, F.lit(""))), F.lit(", "), chamber_name(chamber), F.lit(", "), day, F.lit("] "), c(category), F.lit(": "), c(kind)))


def vote_narrative(question: Column, subject: Column, result: Column, bill_id: Column) -> Column:
    """The parts that are present, a line each."""
    part = lambda label, x: F.when(x != "", F.concat(F.lit(label + ": "), x))
    r, b = clean_text(F.coalesce(result, F.lit(""))), F.trim(F.coalesce(bill_id, F.lit("")))
    all_ = F.struct(vote_pair(question, subject).alias("p"), r.alias("r"), b.alias("b"))
    return let(all_, lambda x: F.concat_ws("\n", part("Question", x["p"]["question"]), part("Subject", x["p"]["subject"]), part("Result", x["r"]), part("Related bill", x["b"])))


def vote_text(prefix: Column, narrative: Column) -> Column:
    return F.when(narrative == "", prefix).otherwise(clean_text(F.concat(prefix, F.lit("\n"), narrative)))


def source_hash(*parts: Column) -> Column:
    """sha256 of the parts joined by ``|``; a null part is empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def chunk_identity(source: Column, doc_hash: Column, section_hash: Column, index: Column, bill_id: Column, enum: Column) -> Column:
    """What a chunk is recognised by: its source hash, else hashes and index, else bill, section and index."""
    full = lambda c: F.coalesce(c, F.lit("")) != ""
    n = F.coalesce(index.cast("string"), F.lit("0"))
    return (
        F.when(full(source), F.concat(F.lit("h|"), source))
        .when(full(doc_hash) & full(section_hash), F.concat_ws("|", F.lit("d"), doc_hash, section_hash, n))
        .otherwise(F.concat_ws("|", F.lit("b"), F.coalesce(bill_id, F.lit("")), F.coalesce(enum, F.lit("")), n))
    )


def hit_line(similarity: Column, bill_id: Column, enum: Column, header: Column, title: Column, body: Column, n: int) -> Column:
    """A search hit for a terminal."""
    some = lambda c, d: F.coalesce(F.nullif(c, F.lit("")), F.lit(d))
    title_part = F.when(F.coalesce(title, F.lit("")) != "", F.concat(F.lit(" | "), title)).otherwise("")
    return F.concat(F.format_string("[%.4f] ", similarity), bill_id, F.lit(" §"), some(enum, "?"), F.lit(" — "), some(header, "(no header)"), title_part, F.lit("\n"), snippet(body, n))


def context_block(rank: Column, fields: list[tuple[str, Column]]) -> Column:
    """A hit as labelled lines for an answering model; missing values show as a dash."""
    lines = [F.concat(F.lit("Result "), rank.cast("string"))]
    lines += [F.concat(F.lit(k + ": "), F.coalesce(F.nullif(v.cast("string"), F.lit("")), F.lit("—"))) for k, v in fields]
    return F.concat_ws("\n", *lines)
