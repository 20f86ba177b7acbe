import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioscope.llm import pii


def found(text):
    base = pii.detect(text)
    return [(pii.KINDS[k], text[s:e]) for s, k, e in sorted([*base, *pii.added(text, base)])]


@pytest.mark.parametrize(
    "text, want",
    [
        ("a@b.co, 1.2.3.4, 4242 4242 4242 4242 +1 (415) 555-2671", [("email", "a@b.co"), ("ip", "1.2.3.4"), ("card", "4242 4242 4242 4242"), ("phone", "+1 (415) 555-2671")]),
        ("mail john.doe [at] example [dot] com now", [("email", "john.doe [at] example [dot] com")]),
        ("jane at example dot com.", [("email", "jane at example dot com")]),
        ("jоhn@exаmple.com", [("email", "jоhn@exаmple.com")]),
        ("ｊｏ＠ｅｘ．ｃｏｍ!", [("email", "ｊｏ＠ｅｘ．ｃｏｍ")]),
        ("bob&#64;site&#46;org", [("email", "bob&#64;site&#46;org")]),
        ("é plus one four one five five five five one two three four é", [("phone", "plus one four one five five five five one two three four")]),
        ("host one nine two dot one six eight dot zero dot one!", [("ip", "one nine two dot one six eight dot zero dot one")]),
        ("4242​4242​4242​4242", [("card", "4242​4242​4242​4242")]),
        ("four two " * 8, [("card", ("four two " * 8).strip())]),
        ("look at example.com, one two three go, at home", []),
        ("300.1.1.1 4242424242424243 +1 234", []),
        ("", []),
    ],
)
def test_spans(text, want):
    assert found(text) == want


def test_base_spans_stay_and_are_never_doubled():
    text = "x@y.zz x [at] y [dot] zz"
    base = pii.detect(text)
    assert len(base) == 1 and [text[s:e] for s, _, e in pii.added(text, base)] == ["x [at] y [dot] zz"]


@pytest.mark.parametrize(
    "text, base, kind",
    [
        ("j\u043ehn@example.com", "hn@example.com", "email"),
        ("jo\u200bhn@example.com", "hn@example.com", "email"),
        ("john@example.c\u043em", "john@example.c", "email"),
        ("j\u043ehn@example.c\u043em", "hn@example.c", "email"),
        ("john@mail.example [dot] com", "john@mail.example", "email"),
        ("john@example.co [dot] uk", "john@example.co", "email"),
        ("john [dot] doe@example.com", "doe@example.com", "email"),
        ("+1 415 555 26 seven one seven", "+1 415 555 26", "phone"),
        ("+1 415 555 26\u200b71", "+1 415 555 26", "phone"),
    ],
)
def test_identifiers_with_a_partial_base_match_are_marked_whole(text, base, kind):
    padded = f"say {text} now"
    spans = pii.detect(padded)
    assert [(pii.KINDS[k], padded[s:e]) for s, k, e in spans] == [(kind, base)]
    more = pii.added(padded, spans)
    assert more and {k for _, k, _ in more} == {pii.KINDS.index(kind)}
    marked = {p for s, _, e in [*spans, *more] for p in range(s, e)}
    assert {p for p in range(4, 4 + len(text)) if not padded[p].isspace()} <= marked <= set(range(4, 4 + len(text)))


@pytest.mark.parametrize(
    "text",
    [
        "john@ example.com",
        "john  @ example.com",
        "john @example.com",
        "john\n@\texample.com",
        "john_at_example.com",
        "john" + " " * 30 + "[at]" + " " * 30 + "example" + " " * 30 + "[dot]" + " " * 30 + "com",
        "john [" + " " * 30 + "at" + " " * 30 + "] example.com",
        "john" + " " * 30 + "at" + " " * 30 + "example" + " " * 30 + "dot" + " " * 30 + "com",
        "a dot " * 20 + "b at " + "c dot " * 20 + "com",
        "a." * 20 + "b at " + "c." * 20 + "d dot com",
    ],
)
def test_any_white_space_and_any_number_of_labels(text):
    assert found(f"say, {text}, now") == [("email", text)]


def test_disguised_identifiers_at_known_places():
    """Identifiers are put into filler text under random disguises; the spans must be just the places where they were put."""
    rng = random.Random(21)
    filler = "the weather in the valley stays fair and people walk along rivers until evening".split()
    names = "zero one two three four five six seven eight nine".split()
    look = {"a": "а", "o": "о", "e": "е", "c": "с", "p": "р", "1": "１", "2": "２", "@": "＠", ".": "．"}

    def luhn_card():
        d = [rng.randrange(10) for _ in range(15)]
        total = sum(x if k % 2 else (x * 2 - 9 * (x > 4)) for k, x in enumerate(d))
        return "".join(map(str, [*d, -total % 10]))

    def disguise(kind):
        if kind == "email":
            local, host = rng.choice(["jane", "joe.poe", "a-c_p", "peacock"]), rng.choice(["example", "cop.mail", "ocean"]) + ".com"
            how = rng.randrange(5)
            if how == 0:
                return f"{local}{rng.choice(['[at]', ' (at) ', ' {AT} ', '&#64;', '<at>'])}{host.replace('.', rng.choice(['[dot]', ' (dot) ', '&#46;']))}"
            if how == 1:
                return f"{local} at {host.replace('.', ' dot ')}"
            if how == 2:
                return f"{local}{rng.choice([' @', '@ ', ' @ '])}{host}"
            plain = f"{local}@{host}"
            if how == 3:
                return "".join(look.get(c, c) for c in plain)
            k = rng.randrange(1, len(local))
            return plain[:k] + "\u200b" + plain[k:]
        if kind == "ip":
            ip = ".".join(str(rng.randrange(100, 256)) for _ in range(4))
            return ip.translate(str.maketrans("0123456789", "０１２３４５６７８９")) if rng.random() < 0.5 else ip.replace(".", rng.choice(["[.]", "(dot)", " [dot] "]))
        if kind == "card":
            return " ".join(names[int(c)] for c in luhn_card())
        digits = [rng.randrange(10) for _ in range(11)]
        return "plus " + rng.choice([" ", "-", ", "]).join(names[d] for d in digits)

    for _ in range(400):
        text, want = "", []
        for _ in range(rng.randint(1, 4)):
            text += " ".join(rng.choice(filler) for _ in range(rng.randint(3, 9))) + ", "
            kind = rng.choice(pii.KINDS)
            x = disguise(kind)
            want.append((kind, x))
            text += x + ", "
        text += "and so on"
        base = pii.detect(text)
        spans = sorted([*base, *pii.added(text, base)])
        covered = [set() for _ in pii.KINDS]
        for s, k, e in spans:
            covered[k] |= set(range(s, e))
        at = 0
        for kind, x in want:
            at = text.index(x, at)
            k = pii.KINDS.index(kind)
            assert set(range(at, at + len(x))) - {at + j for j, c in enumerate(x) if c.isspace()} <= covered[k], (text, kind, x, spans)
            covered[k] -= set(range(at, at + len(x)))
            at += len(x)
        assert not any(covered), (text, want, spans)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(list("a1 .@+-()") + ["25", " at ", " dot ", "one ", "two ", "о", "\u200b", "[at]", "（"]), max_size=40).map("".join))
def test_added_spans_lie_in_the_text_apart_from_base_ones(text):
    base = pii.detect(text)
    for s, k, e in pii.added(text, base):
        assert 0 <= s < e <= len(text) and not any(q == k and s < z and a < e for a, q, z in base)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="1. -+@a_é", max_size=30))
def test_base_equals_plain_regexes(text):
    want = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        want.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) < 256 for x in m[0].split(".")):
            want.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub(r"\D", "", m[0])
        if 12 <= len(d) <= 19 and sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0:
            want.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub(r"\D", "", m[0])) <= 15:
            want.append((m.start(), 3, m.end()))
    assert pii.detect(text) == sorted(want)


@pytest.mark.parametrize("run", ["a", "1", " ", "1.", "+1 ", "a@", "one ", "[ ", "at ", ".", "-", "é", "x_at_"])
def test_long_runs_take_linear_time(run):
    import time

    text = "me@x.yz at q dot com " + run * (200_000 // len(run)) + " one two three a@b.cd"
    began = time.process_time()
    base = pii.detect(text)
    pii.added(text, base)
    assert time.process_time() - began < 8 and any(s == 0 for s, _, _ in base)


@pytest.mark.parametrize("run", ["a dot ", "a at ", "a @ ", "at dot ", "dot dot at ", "a @b.c ", "[ at ", "a_at_b.", "a . dot ", "\n"])
def test_long_runs_of_marks_take_linear_time(run):
    import time

    text = "me@x.yz at q dot com " + run * (200_000 // len(run)) + " one two three a@b.cd"
    began = time.process_time()
    pii.added(text, pii.detect(text))
    assert time.process_time() - began < 16


def test_query_columns(spark):
    rows = [(1, "a@b.co at c [dot] d 1.2.3.4"), (2, None), (3, ""), (1, "a@b.co at c [dot] d 1.2.3.4")]
    got = pii.personal_data(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")).collect()
    assert len(got) == 4 and got[1]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[1]["spans"] == ""
    assert (got[0]["n_email"], got[0]["n_ip"], got[0]["base_sha256"]) == (1, 1, hashlib.sha256(b"email:0:6,ip:20:27").hexdigest())
