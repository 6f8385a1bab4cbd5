"""Language of whole texts and of their spans: scripts, word scores, Viterbi."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrays import SPACE, Words, blocks, column, powers
from .learn import lowest, remainder

# First code point of each script range, and its script.
SCRIPT_RANGES = (
    (0x0041, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"),
    (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"),
    (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x1780, "Khmer"),
    (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2C80, "Coptic"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"),
    (0xF900, "Han"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFF21, "Latin"), (0x20000, "Han"),
)
_FROM = [a for a, _ in SCRIPT_RANGES]


def script_of(word: str) -> str | None:
    """Script of the first letter; None without a letter."""
    for c in word:
        if c.isalpha():
            i = bisect.bisect_right(_FROM, ord(c)) - 1
            return SCRIPT_RANGES[i][1] if i >= 0 else "Other"
    return None


#: Words scored at once.
_CHUNK = 20_000
_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def word_blocks(texts: pa.Array, limit: int):
    """(first text, end text, words) of blocks of lower-cased texts, each with blanks around it and every separator a blank."""
    blank = lambda n: pa.scalar(" " * n, pa.large_string())
    padded = pc.binary_join_element_wise(blank(1), pc.utf8_lower(column(texts)), blank(3), blank(0))
    for lo, hi, data, offsets in blocks(padded, limit):
        yield lo, hi, Words(np.where(SPACE[data], np.uint8(0x20), data), offsets)


class LanguageModel:
    """Naive Bayes over hashed byte runs, with the scripts that each language uses.

    A word scores, for each language, the sum of the log probabilities of the
    runs of 2 to 4 bytes that begin in it or in the blank before it, and of the
    word itself. A language that never uses the word's script is ruled out for
    it, unless no language does. A word with an ASCII letter is Latin, any
    other has the script of its first letter.
    """

    def __init__(self, langs: list[str], tables: np.ndarray, scripts: dict[str, np.ndarray], bits: int):
        self.langs, self.tables, self.scripts, self.bits = langs, tables, scripts, bits
        self.known: dict[bytes, str | None] = {}

    @staticmethod
    def runs(w: Words, a: int, b: int, bits: int) -> list[np.ndarray]:
        """Buckets of the runs that begin at each byte from the blank before word ``a`` to the end of word ``b`` - 1."""
        lo, hi = w.starts[a] - 1, w.stops[b - 1]
        inverse = powers(len(w.data) + 1)[1][lo:hi] * np.uint64(0xD1342543DE82EF95)
        return [((w.sums[lo + n : hi + n] - w.sums[lo:hi]) * inverse >> np.uint64(64 - bits)).astype(np.int64) for n in (2, 3, 4)]

    def scripts_of(self, w: Words) -> list[tuple[str | None, np.ndarray]]:
        """(script, words that have it); None for words without a letter."""
        c = np.concatenate([[0], np.cumsum(_ASCII_LETTER[w.data])])
        latin = c[w.stops] > c[w.starts]
        found: dict[str | None, list[int]] = {}
        if len(self.known) > 200_000:  # memory only
            self.known = {}
        for i in np.flatnonzero(~latin).tolist():
            word = bytes(w.data[w.starts[i] : w.stops[i]])
            if word not in self.known:
                self.known[word] = script_of(word.decode(errors="replace"))
            found.setdefault(self.known[word], []).append(i)
        out = [(s, np.array(at)) for s, at in found.items()]
        return out + ([("Latin", np.flatnonzero(latin))] if latin.any() else [])

    @classmethod
    def fit(cls, texts: list[str], langs: list[str], bits: int = 16) -> LanguageModel:
        names = sorted(set(langs))
        counts = np.zeros((4, 1 << bits, len(names)))
        model = cls(names, counts, {}, bits)
        for k, name in enumerate(names):
            own = pa.array([t for t, lang in zip(texts, langs) if lang == name], pa.large_string())
            for _, _, w in word_blocks(own, 1 << 20):
                for script, at in model.scripts_of(w):
                    if script is not None:
                        model.scripts.setdefault(script, np.zeros(len(names)))[k] += len(at)
                for a in range(0, len(w.starts), _CHUNK):
                    for n, bucket in enumerate(cls.runs(w, a, min(a + _CHUNK, len(w.starts)), bits)):
                        counts[n, :, k] += np.bincount(bucket, minlength=1 << bits)
                counts[3, :, k] += np.bincount((w.hashes() >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        total = np.maximum(counts[3].sum(0), 1)
        model.scripts = {s: v / total > 1e-3 for s, v in model.scripts.items()}
        model.tables = np.log((counts + 0.05) / (counts.sum(1, keepdims=True) + 0.05 * (1 << bits))).astype(np.float32)
        return model

    def word_scores(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(scores, has a letter) of the words of a block; the best language of a word has 0, none less than -60."""
        n = len(w.starts)
        scores, letters = np.zeros((n, len(self.langs)), np.float32), np.ones(n, bool)
        if not n or not self.langs:
            return scores, letters
        for a in range(0, n, _CHUNK):
            b = min(a + _CHUNK, n)
            rows = sum(self.tables[k][bucket] for k, bucket in enumerate(self.runs(w, a, b, self.bits)))
            scores[a:b] = np.add.reduceat(rows, w.starts[a:b] - w.starts[a], axis=0)
        scores += self.tables[3][(w.hashes() >> np.uint64(64 - self.bits)).astype(np.int64)]
        scores -= scores.max(1, keepdims=True)
        for script, at in self.scripts_of(w):
            if script is None:
                letters[at] = False
                scores[at] = 0
                continue
            candidates = self.scripts.get(script)
            if candidates is not None and candidates.any():
                scores[np.ix_(at, ~candidates)] -= 50
        return np.maximum(scores, -60), letters


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word: scores along the path less ``penalty`` for every switch.

    All texts of a block go forward together, one word each per step. A text in
    which no stretch of words gains more than half a penalty in another
    language keeps its best one throughout: n stretches in other languages need
    n - 1 switches at least and gain n halves at most, so that path is the best.
    """
    n, k = scores.shape
    path = np.zeros(n, np.int16)
    lengths = np.diff(bounds)
    if not n or k <= 1:
        return path
    total = np.add.reduceat(np.vstack([scores, np.zeros((1, k), np.float32)]), bounds[:-1], axis=0, dtype=np.float64)
    total[lengths == 0] = 0
    best = total.argmax(1)
    rest = []
    for i in np.flatnonzero(lengths):
        s = scores[bounds[i] : bounds[i + 1]]
        gain = np.cumsum(s - s[:, best[i]][:, None], axis=0, dtype=np.float64)
        low = np.minimum.accumulate(np.vstack([np.zeros((1, k)), gain[:-1]]), axis=0)
        if (gain - low).max() <= penalty / 2:
            path[bounds[i] : bounds[i + 1]] = best[i]
        else:
            rest.append(i)
    if not rest:
        return path
    rest = np.array(rest)[np.argsort(-lengths[rest], kind="stable")]
    start, size = bounds[rest], lengths[rest]
    back = np.zeros((n, k), np.int16)
    v = scores[start].astype(np.float64)
    stay = np.arange(k, dtype=np.int16)
    for t in range(1, size[0]):
        live = int(np.searchsorted(-size, -t))
        v_live = v[:live]
        top = v_live.argmax(1)
        moved = v_live[np.arange(live), top] - penalty
        switch = moved[:, None] > v_live
        back[start[:live] + t] = np.where(switch, top[:, None].astype(np.int16), stay)
        v[:live] = np.where(switch, moved[:, None], v_live) + scores[start[:live] + t]
    now = v.argmax(1).astype(np.int16)
    path[start + size - 1] = now
    for t in range(size[0] - 1, 0, -1):
        live = int(np.searchsorted(-size, -t))
        now[:live] = back[start[:live] + t, now[:live]]
        path[start[:live] + t - 1] = now[:live]
    return path


def learning_ids(docs: DataFrame, mod: int, out: int, sample: int, each: int) -> DataFrame:
    """(doc_id, lang) of the ``sample`` lowest id hashes, and of the ``each`` lowest of every language.

    Ids are counted per language first, on the map side, and only hashes up to
    four times the share that is wanted are shuffled: some 4 x ``each`` of a
    language and 4 x ``sample`` in all, however many rows it has. The counts
    are one row for each language, of which the model holds a table as well.
    """
    wanted = F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", mod) != out)
    rows = docs.select("doc_id", "lang").filter(wanted)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()}
    if not counts:
        return rows.limit(0)
    place = F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 4.0 * each / n)])[F.col("lang")]
    number = F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    rare = rows.filter(place <= share).distinct().withColumn("_n", number).filter(F.col("_n") <= each).drop("_n")
    low = rows.filter(place <= 4.0 * sample / sum(counts.values())).distinct()
    return lowest(low, sample, "lang").unionByName(rare).distinct()


def fit_language(docs: DataFrame, mod: int = 4, out: int = 2, sample: int = 6000, bits: int = 16, each: int = 500) -> LanguageModel:
    """Learn from documents with a language, an id and a remainder other than ``out``: at most ``sample``, and
    up to ``each`` more of every language, so that a rare one is learned from as many."""
    ids = learning_ids(docs, mod, out, sample, each)
    got = docs.select("doc_id", "lang", "text").join(F.broadcast(ids), ["doc_id", "lang"]).toPandas().sort_values(["doc_id", "lang"])
    return LanguageModel.fit(got["text"].fillna("").tolist(), got["lang"].tolist(), bits)


def label_texts(docs: DataFrame, model: LanguageModel, penalty: float = 12.0, spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, n_spans) of each document, or its spans.

    ``score`` is the share of words with a letter that the best path gives to
    ``lang_pred``, the language with most of them (ties: the one with the
    higher sum of scores, then by name). A null text, or one without a letter,
    is ``und`` with score 0 and has no span. With ``spans``: (doc_id,
    first_word, end_word, lang), words without a letter going with the path.
    """
    langs = model.langs

    def words_of(batch):
        for lo, hi, w in word_blocks(batch.column(1), max(1 << 16, (8 << 20) // max(1, len(langs)))):
            scores, letters = model.word_scores(w)
            yield lo, hi, w.bounds, scores, letters, viterbi(scores, w.bounds, penalty)

    def verdicts(batches):
        for batch in batches:
            preds, shares, n_spans = [], [], []
            for lo, hi, bounds, scores, letters, path in words_of(batch):
                for i in range(hi - lo):
                    b, e = bounds[i], bounds[i + 1]
                    has = letters[b:e]
                    count = np.bincount(path[b:e][has], minlength=max(1, len(langs)))
                    if not langs or not count.sum():
                        preds.append("und"), shares.append(0.0), n_spans.append(0)
                        continue
                    top = np.lexsort((-scores[b:e].sum(0), -count))[0]
                    preds.append(langs[top])
                    shares.append(float(count[top] / count.sum()))
                    n_spans.append(int(1 + (np.diff(path[b:e]) != 0).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(preds, pa.string()), pa.array(shares, pa.float64()), pa.array(n_spans, pa.int64())],
                ["doc_id", "lang_pred", "score", "n_spans"],
            )

    def stretches(batches):
        for batch in batches:
            ids, first, end, lang = [], [], [], []
            for lo, hi, bounds, _, letters, path in words_of(batch):
                for i in range(hi - lo):
                    b, e = bounds[i], bounds[i + 1]
                    if not langs or not letters[b:e].any():
                        continue
                    cut = np.concatenate([[0], np.flatnonzero(np.diff(path[b:e])) + 1, [e - b]])
                    for s, t in zip(cut[:-1], cut[1:]):
                        ids.append(batch.column(0)[lo + i].as_py()), first.append(int(s)), end.append(int(t)), lang.append(langs[path[b + s]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(first, pa.int64()), pa.array(end, pa.int64()), pa.array(lang, pa.string())],
                ["doc_id", "first_word", "end_word", "lang"],
            )

    rows = docs.select("doc_id", "text")
    if spans:
        return rows.mapInArrow(stretches, "doc_id long, first_word long, end_word long, lang string")
    return rows.mapInArrow(verdicts, "doc_id long, lang_pred string, score double, n_spans long")


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = label_texts(docs, fit_language(docs))
    return out.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "n_spans")
