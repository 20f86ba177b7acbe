r"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text is built. A text is cross-parsed against
it: from the automaton's root, the longest match is followed to its end, that is one phrase, and the next begins at
the root again. Phrases, weighted by the log of the sample's length and divided by the text's length, estimate the
cross entropy; the least wins. Texts are cut into segments of SEGMENT bytes, which are all parsed (a cut adds at most
one phrase); segments of all texts and languages advance through one table of transitions in lockstep.

Sample: whole labelled texts in order of a hash of (doc_id, text) until ``sample_bytes`` of cleaned text per language,
for the ``most_langs`` languages with most documents. The table of transitions is a second bound: with many languages
each sample is cut until the table fits ``table_bytes``. Cleaning: lower case, runs of anything but letters become one space.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, phrases_per_100 double"
UNDETERMINED = "und"
SEGMENT = 2048
LANES = 4096
_KEEP = np.zeros(256, bool)
_KEEP[0x61:0x7B] = _KEEP[0x80:] = True
_SPACE = 32


def clean(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes with runs of non-letters as one space, and the new offsets."""
    letter = _KEEP[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after each run of letters
    keep[offs[:-1][offs[:-1] < len(data)]] = letter[offs[:-1][offs[:-1] < len(data)]]
    out = np.where(letter, data, _SPACE)[keep].astype(np.uint8)
    before = np.cumsum(keep, dtype=np.int32)
    return out, np.where(offs > 0, before[np.maximum(offs, 1) - 1], 0) if len(before) else offs


class Automaton:
    """Suffix automaton of a byte string; ``edges`` are (state, symbol, state)."""

    def __init__(self, text: bytes) -> None:
        nxt: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in text:
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(nxt)
                    nxt.append(nxt[q].copy())
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
        self.states = len(nxt)
        self.edges = np.array([(s, c, t) for s, d in enumerate(nxt) for c, t in d.items()], np.int32).reshape(-1, 3)


class Model:
    """Automata of all languages in one table: row = state, column = symbol.

    A transition is the next state's row; where there is none, minus the row that the symbol leads to from the root,
    with which the next phrase begins. Row 1 is the state before any phrase and after a symbol unknown to the root.
    """

    def __init__(self, samples: dict[str, bytes], table_bytes: int = 192 << 20) -> None:
        self.langs = sorted(samples)
        # an automaton has under two states a byte; with very many languages the samples shrink to keep the bound
        width = len({c for s in samples.values() for c in s}) + 1
        longest = max(32, table_bytes // (4 * width * 2 * max(1, len(samples))))
        samples = {k: s[:longest] for k, s in samples.items()}
        automata = [Automaton(samples[k]) for k in self.langs]
        seen = np.unique(np.concatenate([a.edges[:, 1] for a in automata])) if automata else np.zeros(0, int)
        self.symbol = np.zeros(256, np.int32)  # 0: never seen
        self.symbol[seen] = np.arange(1, len(seen) + 1)
        self.width = width = len(seen) + 1
        # each language has its own copy of row 1 at the start of its part of the table
        first = np.cumsum([1, *(a.states + 1 for a in automata)])
        self.starts = (first[:-1] * width).astype(np.int64)
        self.table = np.zeros(int(first[-1]) * width, np.int32)
        for a, base in zip(automata, first):
            part = self.table[base * width : (base + a.states + 1) * width].reshape(-1, width)
            s, c, t = a.edges.T
            row = (t + base + 1) * width
            root = np.full(width, base * width, np.int32)
            root[self.symbol[c[s == 0]]] = row[s == 0]
            part[:] = -root
            part[s + 1, self.symbol[c]] = row
        self.weight = np.log2([max(2, len(samples[k])) for k in self.langs])

    def phrases(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        rows, langs = len(offs) - 1, len(self.langs)
        size = np.diff(offs)
        parts = (size + SEGMENT - 1) // SEGMENT
        of = np.repeat(np.arange(rows), parts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offs[:-1][of] + nth * SEGMENT
        length = np.minimum(SEGMENT, offs[1:][of] - begin)
        by = np.argsort(-length, kind="stable")
        begin, length, of = begin[by], length[by], of[by]
        symbols, table = self.symbol[data], self.table
        live = np.searchsorted(-length, -np.arange(1, (length[0] if len(length) else 0) + 1), "right")
        out = np.zeros((rows, langs), np.int64)
        for lo in range(0, len(begin), LANES):
            n = min(LANES, len(begin) - lo)
            state = np.repeat(self.starts[:, None], n, axis=1)
            count = np.zeros((langs, n), np.int32)
            to = np.empty((langs, n), np.int32)
            at = np.empty((langs, n), np.int64)
            for k in range(int(length[lo])):
                m = min(n, int(live[k]) - lo)  # the first m segments have more than k bytes
                if m < n:
                    n, state, count_view, to, at = m, state[:, :m].copy(), count[:, :m], to[:, :m].copy(), at[:, :m].copy()
                else:
                    count_view = count[:, :m]
                np.add(state, symbols[begin[lo : lo + m] + k], out=at)
                np.take(table, at, out=to, mode="clip")
                np.subtract(count_view, to >> 31, out=count_view)
                np.abs(to, out=state)
            for j in range(langs):
                out[:, j] += np.bincount(of[lo : lo + count.shape[1]], weights=count[j], minlength=rows).astype(np.int64)
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and phrases per 100 bytes of each row."""
        names, scores, rates = [], [], []
        for lo, hi in scan.slices(column, 4 << 20):
            part = column.slice(lo, hi - lo)
            lettered = pc.fill_null(pc.match_substring_regex(part, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            data, offs = clean(*scan.texts(pc.utf8_lower(part)))
            n = np.diff(offs)
            if not self.langs or not len(data):
                names += [UNDETERMINED] * (hi - lo)
                scores.append(np.zeros(hi - lo))
                rates.append(np.zeros(hi - lo))
                continue
            count = self.phrases(data, offs)
            bits = count * self.weight / np.maximum(n, 1)[:, None]
            best = bits.argmin(axis=1)
            order = np.sort(bits, axis=1)
            second = order[:, 1] if len(self.langs) > 1 else order[:, 0] * 2
            # odds of the best against the second, from the difference of the two code lengths
            gap = np.minimum((second - order[:, 0]) * n, 60.0)
            score = np.where(lettered, 1 - 0.5 * np.exp2(-gap / 4), 0.0)
            names += [self.langs[b] if ok else UNDETERMINED for b, ok in zip(best, lettered)]
            scores.append(score)
            rates.append(np.where(lettered, 100 * count[np.arange(hi - lo), best] / np.maximum(n, 1), 0.0))
        none = np.zeros(0)
        return names, np.concatenate(scores or [none]), np.concatenate(rates or [none])


def held_out() -> Column:
    """crc32(doc_id as text) mod 3 = 1; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, sample_bytes: int = 32 << 10, candidates: int = 400, most_langs: int = 10_000) -> Model:
    """Learns from a bounded sample: at most ``candidates`` documents and ``sample_bytes`` of text a language, of the
    ``most_langs`` languages with most labelled documents.

    Counts per language give the share of a hash range that holds about twice ``candidates`` documents, so the sample
    is drawn by one filtered scan; nothing but the sample leaves it. Null or empty texts and null languages are not used.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out())
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.octet_length("text")), F.lit(1 << 30))
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_langs)
    per_lang = {r["lang"]: r["count"] for r in counts.collect()}
    if not per_lang:
        return Model({})
    below = [(k, min(1 << 30, int(2 * candidates / n * (1 << 30)) + 1)) for k, n in per_lang.items()]
    below = docs.sparkSession.createDataFrame(below, "lang string, below long")  # a row per language, most_langs at most
    drawn = rows.withColumn("draw", draw).join(F.broadcast(below), "lang").where("draw < below")
    # at 32 bits a character, a text's first sample_bytes characters are all that can enter the sample
    drawn = drawn.select("lang", "draw", "doc_id", F.substring("text", 1, sample_bytes).alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")))
    top = drawn.withColumn("nth", nth).where(F.col("nth") <= candidates)
    room = F.sum(F.octet_length("text")).over(Window.partitionBy("lang").orderBy("nth")) - F.octet_length("text")
    samples: dict[str, bytearray] = {}
    for r in top.withColumn("room", room).where(F.col("room") < 2 * sample_bytes).orderBy("lang", "nth").toLocalIterator():
        into = samples.setdefault(r["lang"], bytearray())
        data, _ = clean(*scan.texts(pa.array([r["text"].lower()])))
        into += data.tobytes()[: max(0, sample_bytes - len(into))]
    return Model({k: bytes(v) for k, v in samples.items() if v})


def _predicted(rows: DataFrame, model: Model, schema: str, build) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)  # bounded: states and symbols of samples of fixed size

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return build(batch, *shared.value.predict(batch.column(batch.schema.get_field_index("text"))))

    return scan.map_arrow(rows, run, schema)


def identify(docs: DataFrame, model: Model | None = None, sample_bytes: int = 32 << 10) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1), phrases_per_100.

    ``und``, score 0: null text, text without a letter, or no labelled text to learn from. doc_id, lang and source
    take no part in a prediction. Extra columns are dropped. A narrow map after the bounded fit: no shuffle of texts.
    """
    model = model or fit(docs, sample_bytes)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), F.col("text").cast("string").alias("text"))

    def build(batch: pa.RecordBatch, names: list[str], score: np.ndarray, rate: np.ndarray) -> pa.RecordBatch:
        arrays = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rate)]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return _predicted(rows, model, SCHEMA, build)


def accepted(docs: DataFrame, least: float = 0.5, languages: tuple[str, ...] | None = None, sample_bytes: int = 32 << 10) -> DataFrame:
    """The rows of ``docs``, all columns kept, whose language is told: with a score above ``least``, and, where they are given,
    one of ``languages``.

    A score of 0.5 is a tie: the two best languages explain the text equally well, as they do a word that both have. Null
    and empty texts and texts without a letter go. Rows are judged one by one; repeated rows all stay or all go. Without any
    labelled text nothing can be told, and all go.
    """
    model = fit(docs, sample_bytes)

    def build(batch: pa.RecordBatch, names: list[str], score: np.ndarray, rate: np.ndarray) -> pa.RecordBatch:
        told = np.array([n != UNDETERMINED and (languages is None or n in languages) for n in names], bool)
        return batch.filter(pa.array(told & (score > least)))

    return _predicted(docs, model, docs.schema, build)
