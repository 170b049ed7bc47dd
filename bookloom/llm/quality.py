"""Per-document text quality: line labels by a hidden Markov model, and plain measures.

Every line that is not blank is described by a few discrete features and is
labelled prose, list, table or junk by a hidden Markov model (Viterbi); a
document's label shares are weighted by characters.  All features are computed
over arrays of code points, many documents at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.operators.graph import clean_key

LABELS = ["prose", "list", "table", "junk"]
#: Labelled documents the model is fitted on at most, those with the smallest hashed id first.
MAX_LABELLED = 4000
#: Code points described at a time.
CHUNK = 1 << 20
#: Chance that the next line has the label of the one before.
STAY = 0.9
#: Rounds of re-estimation from the model's own line labels.
ROUNDS = 3
#: Lines of evidence the starting table counts for.
PRIOR_LINES = 40.0

# Frequent function words of English, German, French and Czech.
COMMON = """the of and to in a is that it for was with as be by on not he she they we his her had has have were this which when what if
der die das und ist nicht mit sie ein eine zu den von wenn hat als auch nur war haben werden sind dass aber ohne man es wer dann
le la les de des et est un une que qui ne pas il elle dans pour sur ce on se sont avec du en mais ont
se na je že to v a s z i jak by jen tak když co pro ale nebo ani už kdo ten pak nikdy není byl byla bylo za o po do podle něj jako""".split()

# Names of the line features and how many values each has.
FEATURES = {"common": 4, "digits": 4, "symbols": 4, "fields": 3, "ends": 3, "marker": 4, "damage": 3, "size": 4, "repeats": 2, "commas": 3, "wide": 2, "capitals": 2, "solid": 3, "tangled": 2}

# Starting chances of each feature value under prose, list, table and junk.
START = {
    "common": ([0.08, 0.12, 0.40, 0.40], [0.90, 0.08, 0.015, 0.005], [0.96, 0.03, 0.005, 0.005], [0.80, 0.14, 0.04, 0.02]),
    "digits": ([0.95, 0.045, 0.004, 0.001], [0.45, 0.20, 0.25, 0.10], [0.05, 0.05, 0.20, 0.70], [0.50, 0.20, 0.25, 0.05]),
    "symbols": ([0.96, 0.03, 0.008, 0.002], [0.75, 0.10, 0.10, 0.05], [0.60, 0.10, 0.15, 0.15], [0.35, 0.05, 0.10, 0.50]),
    "fields": ([0.985, 0.01, 0.005], [0.97, 0.02, 0.01], [0.10, 0.20, 0.70], [0.90, 0.07, 0.03]),
    "ends": ([0.25, 0.65, 0.10], [0.55, 0.03, 0.42], [0.25, 0.05, 0.70], [0.60, 0.15, 0.25]),
    "marker": ([0.93, 0.06, 0.007, 0.003], [0.35, 0.35, 0.15, 0.15], [0.85, 0.03, 0.005, 0.115], [0.94, 0.04, 0.01, 0.01]),
    "damage": ([0.93, 0.06, 0.01], [0.98, 0.015, 0.005], [0.98, 0.015, 0.005], [0.60, 0.05, 0.35]),
    "size": ([0.05, 0.25, 0.35, 0.35], [0.40, 0.40, 0.19, 0.01], [0.35, 0.55, 0.09, 0.01], [0.25, 0.25, 0.35, 0.15]),
    "repeats": ([0.999, 0.001], [0.997, 0.003], [0.997, 0.003], [0.60, 0.40]),
    "commas": ([0.60, 0.38, 0.02], [0.45, 0.05, 0.50], [0.97, 0.02, 0.01], [0.85, 0.13, 0.02]),
    "wide": ([0.998, 0.002], [0.90, 0.10], [0.97, 0.03], [0.70, 0.30]),
    "capitals": ([0.995, 0.005], [0.97, 0.03], [0.97, 0.03], [0.70, 0.30]),
    "solid": ([0.001, 0.004, 0.995], [0.005, 0.095, 0.90], [0.05, 0.25, 0.70], [0.30, 0.20, 0.50]),
    "tangled": ([0.998, 0.002], [0.995, 0.005], [0.995, 0.005], [0.65, 0.35]),
}

#: Flags: bytes and words of a useful text, and characters looked at on either end.
LEAST_BYTES, LEAST_WORDS, SAMPLE = 2000, 300, 5000
# Traces of wrong decoding, of other books' praise in front and of advertising at the end.
_SIGNALS = re.compile("ï¿½|â€|Ã[^\n\r\u2028\u2029]|\ufffd")
_SIGNAL_PARTS = ["ï¿½", "â€", "Ã", "\ufffd"]
_NOISE = ["praise for", "promotional download"]
_MARKETING = ["what's next on your reading list", "what’s next on your reading list", "also of interest"]

_LETTER, _UPPER, _DIGIT, _SPACE, _SYMBOL, _COMMA, _END, _CLOSE, _TAB, _SEMI, _SLASH, _BULLET, _LEAD, _ODD = (1 << i for i in range(14))


def _classes() -> np.ndarray:
    """For each code point below 0x3000 the classes it belongs to, as bits."""
    out = np.zeros(0x3000, dtype=np.uint16)
    for c in range(0x3000):
        ch = chr(c)
        if ch.isalpha():
            out[c] |= _LETTER
            if ch.isupper():
                out[c] |= _UPPER
        elif ch.isdigit():
            out[c] |= _DIGIT
        elif ch.isspace():
            out[c] |= _SPACE
        elif ch not in ".,;:!?'\"()-–—“”‘’„…«»":
            out[c] |= _SYMBOL
        for bit, chars in ((_COMMA, ","), (_END, ".!?…;:"), (_CLOSE, "\"'”’“»)"), (_TAB, "\t"), (_SEMI, ";"), (_SLASH, "/"), (_BULLET, "*•·–-‣—+"), (_LEAD, "ÃÅÄÂâÆ")):
            if ch in chars:
                out[c] |= bit
        if c > 127 and not ch.isalpha() and ch not in "–—“”‘’„…«»":
            out[c] |= _ODD
    return out


_CLASS = _classes()
_LOWER = np.array([ord(chr(c).lower()[0]) for c in range(0x3000)], dtype=np.uint32)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _word_hash(word: str) -> np.uint64:
    h = 0
    for i, ch in enumerate(word):
        h = (h + (ord(ch) + 1) * pow(int(_MULT), i, 1 << 64)) % (1 << 64)
    return np.uint64(h)


_COMMON_HASHES = np.array(sorted({int(_word_hash(w)) for w in COMMON}), dtype=np.uint64)


class Tables:
    """Powers for hashing the words of one chunk."""

    def __init__(self, n: int) -> None:
        self.up, self.down = (np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, b, dtype=np.uint64)))) for b in (_MULT, _INV))


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[ends] - total[starts]


def describe(texts: list[str], tables: Tables) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """(measures per text, text of each line, characters of each line, features of each line)."""
    n = len(texts)
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if len(codes) + 1 > len(tables.up):
        tables.__init__(len(codes) + 1)
    low = np.minimum(codes, 0x2FFF)
    kinds = _CLASS[low]
    kinds[codes > 0x2FFF] = 0
    kinds[codes == 0xFFFD] = _SYMBOL
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=n)
    doc_end = np.cumsum(sizes + 1)
    doc_start = doc_end - sizes - 1

    # words: runs of anything but space, tab, CR and LF
    gap = (codes == 32) | (codes == 9) | (codes == 10) | (codes == 13)
    edge = np.diff(gap.astype(np.int8), prepend=np.int8(1))
    w_start, w_end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(w_end) and len(w_start) and w_end[0] < w_start[0]:
        w_end = w_end[1:]

    # lines with something on them
    breaks = np.flatnonzero(codes == 10)
    l_start, l_end = np.concatenate(([0], breaks[:-1] + 1)), breaks
    first_word = np.searchsorted(w_start, l_start)
    words = np.searchsorted(w_start, l_end) - first_word
    keep = words > 0
    l_start, l_end, first_word, words = l_start[keep], l_end[keep], first_word[keep], words[keep]
    last_word = first_word + words - 1
    line_doc = np.searchsorted(doc_end, l_start, side="right")

    def per_line(bit: int) -> np.ndarray:
        return _sums((kinds & bit) != 0, l_start, l_end)

    letters, digits, symbols, spaces = per_line(_LETTER), per_line(_DIGIT), per_line(_SYMBOL), per_line(_SPACE)
    chars = np.maximum(l_end - l_start - spaces, 1)
    lower = np.where(codes < 0x3000, _LOWER[low], codes).astype(np.uint64)

    # words without the signs around them, hashed
    wordy = (kinds & (_LETTER | _DIGIT)) != 0
    lead = wordy[w_start]
    trail = wordy[w_end - 1]
    core_s, core_e = w_start + (~lead), np.maximum(w_end - (~trail), w_start + (~lead))
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((lower + np.uint64(1)) * tables.up[: len(codes)], out=total[1:])
    hashed = (total[core_e] - total[core_s]) * tables.down[core_s]
    at = np.minimum(np.searchsorted(_COMMON_HASHES, hashed), len(_COMMON_HASHES) - 1)
    common = _COMMON_HASHES[at] == hashed
    word_sums = lambda flags: _sums(flags, first_word, last_word + 1)
    common_words = word_sums(common)
    again = np.zeros(len(w_start), dtype=bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (core_e[1:] > core_s[1:])
    again[first_word] = False
    repeats = word_sums(again)
    capital = ((kinds & _UPPER) != 0) | ((kinds & _LETTER) == 0)
    shouted = (_sums(capital, w_start, w_end) == w_end - w_start) & (core_e - core_s >= 3) & ((kinds[core_s] & _UPPER) != 0)
    loud = word_sums(shouted)

    moji = np.zeros(len(codes), dtype=bool)
    moji[:-1] = ((kinds[:-1] & _LEAD) != 0) & ((kinds[1:] & _ODD) != 0)
    damaged = _sums(moji | (codes == 0xFFFD), l_start, l_end)
    double = np.zeros(len(codes), dtype=bool)
    double[1:-1] = (codes[1:-1] == 32) & (codes[:-2] == 32) & (codes[2:] != 32)
    gaps = _sums(double, l_start, l_end)
    dots = np.zeros(len(codes), dtype=bool)
    dots[1:] = (codes[1:] == 46) & (codes[:-1] == 46)
    leaders = _sums(dots, l_start, l_end)
    small = ((kinds & _LETTER) != 0) & ((kinds & _UPPER) == 0)
    turn = np.zeros(len(codes), dtype=bool)
    turn[1:] = (small[:-1] & ((kinds[1:] & (_UPPER | _DIGIT)) != 0)) | (((kinds[:-1] & _DIGIT) != 0) & ((kinds[1:] & _LETTER) != 0))
    turns = _sums(turn, l_start, l_end)
    cell = np.zeros(len(codes), dtype=bool)
    cell[1:-1] = (codes[1:-1] == 124) & np.isin(codes[:-2], (10, 32, 45)) & np.isin(codes[2:], (10, 32, 45))
    pipes = _sums(cell, l_start, l_end)
    symbols = symbols - pipes
    tabs, semis, slashes, commas = per_line(_TAB), per_line(_SEMI), per_line(_SLASH), per_line(_COMMA)

    head, tail = w_start[first_word], w_end[last_word] - 1
    closing = (kinds[tail] & _CLOSE) != 0
    end_at = np.where(closing & (tail > head), tail - 1, tail)
    ends = np.where((kinds[end_at] & _END) != 0, 1, np.where(((kinds[tail] & (_DIGIT | _COMMA)) != 0) | (codes[tail] == 93), 2, 0))
    bullet = ((kinds[head] & _BULLET) != 0) & (w_end[first_word] - head == 1) & (words > 1)
    numbered = ((kinds[head] & _DIGIT) != 0) & np.isin(codes[w_end[first_word] - 1], (46, 41)) & (words > 1)
    keyed = (codes[w_end[first_word] - 1] == 58) & (words <= 2)
    marker = np.select([leaders >= 3, (slashes >= 2) & (words == 1), keyed, bullet | numbered], [2, 2, 3, 1], 0)
    fields = tabs + semis * (semis >= 2) + pipes * (pipes >= 2) + gaps + (keyed & (words <= 2)) * 1
    mean = chars / words

    def steps(x: np.ndarray, *limits: float) -> np.ndarray:
        return np.searchsorted(np.array(limits), x, side="left")

    features = np.stack([
        steps(common_words / words, 1e-9, 0.12, 0.28), steps(digits / chars, 1e-9, 0.1, 0.35), steps(symbols / chars, 1e-9, 0.05, 0.15), np.minimum(fields, 2),
        ends, marker, steps(damaged / words, 1e-9, 0.12), steps(words, 3, 8, 25), repeats * 3 >= words, steps(commas / words, 1e-9, 0.55), mean > 20, (loud >= 2) & (loud * 8 >= words),
        steps((letters + digits + pipes) / chars, 0.35, 0.6), (turns >= 2) & (turns >= words),
    ]).astype(np.int8)

    own_words = np.searchsorted(w_start, doc_end) - np.searchsorted(w_start, doc_start)
    by_doc = lambda x: np.bincount(line_doc, weights=x, minlength=n)
    solid = by_doc(chars)
    lines = by_doc(np.ones(len(l_start)))
    safe = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    measures = pd.DataFrame({
        "words": own_words, "replacementCharacters": _sums(codes == 0xFFFD, doc_start, doc_end - 1), "chars": sizes, "lines": lines.astype(np.int64), "meanWordLength": safe(by_doc(letters + digits), own_words),
        "symbolRatio": safe(by_doc(symbols), solid), "digitRatio": safe(by_doc(digits), solid), "endShare": safe(by_doc(ends == 1), lines), "commonShare": safe(by_doc(common_words), own_words), "mojibakeSignals": by_doc(damaged).astype(np.int64),
    })
    return measures, line_doc, chars, features


class LineModel:
    """A hidden Markov model over line labels with independent discrete features."""

    def __init__(self, emissions: list[np.ndarray], start: np.ndarray, move: np.ndarray) -> None:
        self.emissions, self.start, self.move = emissions, start, move

    @classmethod
    def starting(cls) -> LineModel:
        move = np.full((4, 4), (1 - STAY) / 3)
        np.fill_diagonal(move, STAY)
        return cls([np.array(START[f]).T for f in FEATURES], np.array([0.82, 0.06, 0.06, 0.06]), move)

    def scores(self, features: np.ndarray) -> np.ndarray:
        return sum(np.log(e)[v] for e, v in zip(self.emissions, features))

    def labels(self, features: np.ndarray, doc: np.ndarray, n: int, prior: np.ndarray | None = None) -> np.ndarray:
        """The likeliest labels of each text's lines; texts are stepped through side by side."""
        score = self.scores(features)
        if prior is not None:
            score = score + prior[doc]
        counts = np.bincount(doc, minlength=n)
        first = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        sizes = counts[order]
        move, back = np.log(self.move), np.zeros(score.shape, dtype=np.int8)
        best = np.zeros((n, 4))
        for t in range(int(counts.max(initial=0))):
            live = order[: np.searchsorted(-sizes, -t, side="left")]
            at = first[live] + t
            if t == 0:
                best[live] = np.log(self.start) + score[at]
            else:
                ways = best[live][:, :, None] + move
                back[at] = ways.argmax(axis=1)
                best[live] = ways.max(axis=1) + score[at]
        out = np.zeros(len(doc), dtype=np.int8)
        state = best.argmax(axis=1)
        for t in range(int(counts.max(initial=0)) - 1, -1, -1):
            live = order[: np.searchsorted(-sizes, -t, side="left")]
            at = first[live] + t
            out[at] = state[live]
            state[live] = back[at, state[live]]
        return out

    @classmethod
    def fitted(cls, texts: list[str], labels: list[str]) -> LineModel:
        """Hard re-estimation: lines are labelled with a leaning to their document's label, then counted."""
        model = cls.starting()
        if not texts:
            return model
        _, doc, _, features = describe(texts, Tables(sum(map(len, texts)) + len(texts) + 1))
        lean = np.zeros((len(texts), 4))
        lean[np.arange(len(texts)), [LABELS.index(x) for x in labels]] = 1.0
        for _ in range(ROUNDS):
            state = model.labels(features, doc, len(texts), lean)
            emissions = []
            for old, values in zip(cls.starting().emissions, features):
                counts = np.zeros_like(old)
                np.add.at(counts, (values, state), 1.0)
                # a label's evidence counts for as many lines as its documents have, but no more than five times the prior
                weight = np.minimum(1.0, 5 * PRIOR_LINES / np.maximum(counts.sum(axis=0), 1))
                counts = counts * weight + PRIOR_LINES * old
                emissions.append(counts / counts.sum(axis=0))
            model = cls(emissions, model.start, model.move)
        return model


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> tuple[list[str], list[str]]:
    """Texts and labels of at most ``most`` labelled documents; labels are trimmed and lower-cased."""
    known = labels.select("doc_id", clean_key(F.col("label")).alias("label")).where(F.col("label").isin(LABELS) & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.countDistinct("label").alias("k")).where("k = 1").drop("k")
    some = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(some), "doc_id").toPandas().sort_values("doc_id")
    return rows["text"].tolist(), rows["label"].tolist()


SCHEMA = (
    "doc_id bigint, bytes bigint, words bigint, replacementCharacters bigint, flags array<string>, chars bigint, lines bigint, meanWordLength double, symbolRatio double, digitRatio double, endShare double, "
    "commonShare double, mojibakeSignals bigint, proseShare double, listShare double, tableShare double, junkShare double, kind string"
)


def flags(text: str, size: int, words: int) -> list[str]:
    """What an audit notes of a text; samples are counted in UTF-16 units."""
    first = text[:SAMPLE].encode("utf-16-le", "surrogatepass")[: 2 * SAMPLE].decode("utf-16-le", "ignore")
    last = text[-SAMPLE:].encode("utf-16-le", "surrogatepass")[-2 * SAMPLE :].decode("utf-16-le", "ignore")
    has = lambda sample, phrases: any(p in sample for p in phrases)
    signals = len(_SIGNALS.findall(text)) if has(text, _SIGNAL_PARTS) else 0
    found = {
        "too_small": size < LEAST_BYTES, "too_few_words": words < LEAST_WORDS, "heavy_mojibake": signals > max(20, words / 500),
        "frontmatter_noise": has(first.lower(), _NOISE), "endmatter_marketing": has(last.lower(), _MARKETING),
    }
    return [name for name, holds in found.items() if holds]


def quality(docs: DataFrame, model: LineModel) -> DataFrame:
    """One row per document: measures, the share of each line label by characters, and the document's kind.

    ``kind`` is the label with the largest share (prose on a tie); a text without
    any word, or null, has shares of 0 and the kind ``empty``.  Words are runs
    of anything but space, tab, CR and LF.  Extra columns are ignored.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(CHUNK + (1 << 18))
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            out, lo = [], 0
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < CHUNK):
                    size += len(texts[hi])
                    hi += 1
                rows, doc, chars, features = describe(texts[lo:hi], tables)
                state = model.labels(features, doc, hi - lo)
                shares = np.zeros((hi - lo, 4))
                np.add.at(shares, (doc, state), chars)
                sums = shares.sum(axis=1)
                shares /= np.maximum(sums, 1)[:, None]
                for i, label in enumerate(LABELS):
                    rows[f"{label}Share"] = shares[:, i]
                rows["bytes"] = [len(x.encode("utf-8", "surrogatepass")) for x in texts[lo:hi]]
                rows["flags"] = [flags(*x) for x in zip(texts[lo:hi], rows["bytes"], rows["words"])]
                rows["kind"] = np.where(sums > 0, np.array(LABELS)[shares.argmax(axis=1)], "empty")
                out.append(rows)
                lo = hi
            if out:
                rows = pd.concat(out)
                rows.insert(0, "doc_id", ids.to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_pandas(rows, schema=arrow, preserve_index=False)

    kinds = {"bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    arrow = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SCHEMA.split(", ")])
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(measured, SCHEMA)


def stale_audits(measured: DataFrame, audit: DataFrame) -> DataFrame:
    """doc_id of every document with an audit row whose words or replacement characters differ from the text; nulls differ from nothing."""
    rows = audit.select("doc_id", F.col("words").alias("w"), F.col("replacementCharacters").alias("r")).distinct()
    joined = measured.select("doc_id", "words", "replacementCharacters").join(rows, "doc_id")
    differs = [F.coalesce(F.col(old) != F.col(new), F.lit(False)) for old, new in (("w", "words"), ("r", "replacementCharacters"))]
    return joined.where(differs[0] | differs[1]).select("doc_id").distinct()


#: Measures an audit row states.
AUDITED = ["bytes", "words", "replacementCharacters", "flags"]


def audit_differences(measured: DataFrame, audit: DataFrame) -> DataFrame:
    """Every distinct audit row, the measures of its document's text, and in ``differs`` the names of those it has wrong.

    Nulls of the audit differ from nothing, flags are compared as sets;
    ``differs`` is null for a row about no document.
    """
    rows = audit.select("doc_id", "auditedAt", *AUDITED).distinct()
    texts = measured.select("doc_id", F.lit(True).alias("found"), *[F.col(c).alias(f"text_{c}") for c in AUDITED]).distinct()
    same = {c: F.col(c) == F.col(f"text_{c}") for c in AUDITED} | {"flags": F.array_sort(F.array_distinct("flags")) == F.array_sort("text_flags")}
    differs = F.array_compact(F.array(*[F.when(~same[c], c) for c in AUDITED]))
    return rows.join(texts, "doc_id", "left").withColumn("differs", F.when(F.col("found"), differs)).drop("found")
