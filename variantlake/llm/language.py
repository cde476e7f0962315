"""Language identification with labelled spans of mixed text.

``learn`` counts, per language, the scripts of letters and hashed letter sequences of
words over all labelled rows. ``with_language`` scores each word against the languages
whose training text holds its script; a Viterbi pass over the words of a text, with a
penalty for each switch of language, labels the spans. The text's language is the one
with the most letters in spans, the score its share of the letters.

A text in which no stretch of words gains more than one penalty over its best single
language has exactly one span; this is seen for a whole batch at once, and only the
other texts are stepped through.

Defined results: words are runs of ASCII letters and of characters beyond ASCII, in
lower case; a null text, or one without a letter, is ``und`` with score 0; words in a
script that no language has give no evidence (then the most frequent language decides);
rows without a language are not learned from, and with none learned at all every text
is ``und``. Ties go to the language that sorts first. Equal texts get equal results.
The model holds ``FEATURES`` numbers a language whatever the corpus.
"""

from __future__ import annotations

import zlib
from bisect import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import text_batches, text_udf

UNKNOWN = "und"
FEATURES = 1 << 16
SMOOTHING = 0.1
#: share of a language's letters that a script needs for the language to be a candidate
LEAST_SCRIPT = 0.001
#: thousandths of a nat; what one switch costs, and what a language without the script loses a word
SWITCH = 12_000
OTHER_SCRIPT = 20_000
CACHED_WORDS = 300_000

#: first code point and name of ranges with one script (others: by the range before)
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "oriya"), (0x0B80, "tamil"),
    (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"),
    (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x32000, "other"),
]
STARTS = [s for s, _ in SCRIPTS]

LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
SPANS = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
LANGUAGE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", SPANS)])


def words_of(text: str | None) -> list[bytes]:
    return text.lower().encode().translate(LETTERS).split() if text else []


def script_of(word: str) -> tuple[str, int]:
    """Script of the first letter, and the number of letters."""
    if word.isascii():
        return "latin", len(word)
    letters = [c for c in word if c.isalpha()]
    return (SCRIPTS[bisect(STARTS, ord(letters[0])) - 1][1] if letters else ""), len(letters)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def features_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed three- and four-byte sequences of the marked words, and the words: (features, word number of each)."""
    marked = [b"<" + w + b">" for w in words]
    held = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    of = np.repeat(np.arange(len(marked)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(held))  # bytes up to the word's end
    crc, found, number = np.full(len(held), 0xFFFFFFFF, np.uint32), [], []
    for step in range(4):
        at = np.flatnonzero(left > step)
        crc[at] = CRC[(crc[at] ^ held[at + step]) & 0xFF] ^ (crc[at] >> 8)
        if step >= 2:
            found.append((crc[at] ^ np.uint32(0xFFFFFFFF)) & np.uint32(FEATURES - 1))
            number.append(of[at])
    whole = np.fromiter((zlib.crc32(m) & (FEATURES - 1) for m in marked), np.uint32, len(marked))
    return np.concatenate([*found, whole]).astype(np.int64), np.concatenate([*number, np.arange(len(marked))])


class Model:
    """Log probabilities (thousandths of a nat) of features, scripts and languages."""

    def __init__(self, features: dict[str, np.ndarray], scripts: dict[str, dict[str, int]], texts: dict[str, int]):
        self.languages = sorted(texts)
        n = len(self.languages)
        self.log = np.zeros((FEATURES, n), np.int32)
        self.script: dict[str, np.ndarray] = {}
        for i, lang in enumerate(self.languages):
            counts = features.get(lang, np.zeros(FEATURES)) + SMOOTHING
            self.log[:, i] = np.round(1000 * np.log(counts / counts.sum()))
        for name in {s for by in scripts.values() for s in by}:
            share = [scripts.get(lang, {}).get(name, 0) / max(1, sum(scripts.get(lang, {}).values())) for lang in self.languages]
            self.script[name] = np.array(share) >= LEAST_SCRIPT
        total = max(1, sum(texts.values()))
        self.prior = np.array([round(1000 * float(np.log(texts[lang] / total))) for lang in self.languages], np.int64)

    def scores(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores by language and numbers of letters of distinct words."""
        features, of = features_of(words)
        scores = np.zeros((len(words), len(self.languages)), np.int64)
        for i in range(len(self.languages)):
            scores[:, i] = np.bincount(of, self.log[features, i], len(words)).astype(np.int64) // 2  # sequences overlap; sums are whole numbers
        found = [script_of(word.decode()) for word in words]
        letters = np.fromiter((n for _, n in found), np.int64, len(found))
        names = np.array([name for name, _ in found], object)
        for name in set(names.tolist()):
            at, fits = np.flatnonzero(names == name), self.script.get(name)
            if fits is None or not fits.any():
                scores[at] = 0
            elif not fits.all():
                scores[np.ix_(at, np.flatnonzero(~fits))] = (scores[np.ix_(at, np.flatnonzero(fits))].min(axis=1) - OTHER_SCRIPT)[:, None]
        return scores, letters


def viterbi(scores: np.ndarray, prior: np.ndarray, switch: int = SWITCH) -> np.ndarray:
    """The best labels of one text's words (rows of ``scores``)."""
    return _labels([scores], prior, switch)[0]


def _labels(texts: list[np.ndarray], prior: np.ndarray, switch: int) -> list[np.ndarray]:
    """Viterbi over several texts at once; the longest first, so that the running ones stand in front."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    running = np.array([len(texts[i]) for i in order])
    best = np.tile(prior, (len(texts), 1))
    come_from = []
    for step in range(int(running[0]) if len(order) else 0):
        n = int(np.searchsorted(-running, -step, "left"))
        now = best[:n]
        if step:
            top = now.argmax(axis=1)
            moved = now[np.arange(n), top][:, None] - switch
            come_from.append(np.where(now >= moved, np.arange(now.shape[1]), top[:, None]))
            now = np.maximum(now, moved)
        best[:n] = now + np.array([texts[i][step] for i in order[:n]])
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
    for row, i in enumerate(order):
        labels = np.empty(len(texts[i]), np.int64)
        label = int(best[row].argmax())
        for step in range(len(labels) - 1, -1, -1):
            labels[step] = label
            if step:
                label = int(come_from[step - 1][row, label])
        out[i] = labels
    return out


class Labeller:
    def __init__(self, model: Model, switch: int = SWITCH):
        self.model, self.switch = model, switch
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores, self.letters = np.empty((0, len(self.model.languages)), np.int64), np.empty(0, np.int64)

    def __call__(self, texts: list) -> list[list]:
        words = [words_of(t) for t in texts]
        if len(self.index) > CACHED_WORDS:
            self._reset()
        if new := sorted({w for of_text in words for w in of_text}.difference(self.index)):
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            scores, letters = self.model.scores(new)
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
        find = self.index.__getitem__
        codes = np.array([c for of_text in words for c in map(find, of_text)], np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        single, mixed = self._single(codes, sizes, ends)
        stepped = iter(_labels([self.scores[codes[ends[i] - sizes[i] : ends[i]]] for i in mixed], self.model.prior, self.switch))
        out: list[list] = [[], [], []]
        mixed = set(mixed)
        for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
            letters = self.letters[codes[end - n : end]]
            labels = next(stepped) if i in mixed else np.full(n, single[i])
            total = int(letters.sum())
            if not total or not self.model.languages:
                row = UNKNOWN, 0.0, []
            else:
                by = np.bincount(labels, letters, len(self.model.languages))
                starts = np.flatnonzero(np.concatenate(([True], labels[1:] != labels[:-1]))).tolist()
                spans = [
                    {"lang": self.model.languages[labels[a]], "start": a, "end": b} for a, b in zip(starts, [*starts[1:], n], strict=True)
                ]
                row = self.model.languages[int(by.argmax())], float(by.max() / total), spans
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return out

    def _single(self, codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
        """Best single language of each text, and the texts in which a switch might pay."""
        count, n = len(sizes), len(self.model.languages)
        if not n or not len(codes):
            return [0] * count, []
        scores = self.scores[codes]
        with_words = np.flatnonzero(sizes)
        first = (ends - sizes)[with_words]
        scores[first] += self.model.prior
        best = np.zeros(count, np.int64)
        best[with_words] = np.add.reduceat(scores, first, axis=0).argmax(axis=1)
        own = np.repeat(best, sizes)
        gain = scores - scores[np.arange(len(codes)), own][:, None]
        gain[np.arange(len(codes)), own] = np.iinfo(np.int64).min // 4
        gain = gain.max(axis=1) if n > 1 else np.full(len(codes), -1)
        # the running sum falls below all earlier ones at each text's start, so the least sum so far lies in the text
        rises = np.zeros(count, np.int64)
        rises[with_words] = np.add.reduceat(np.maximum(gain, 0), first)
        at = np.insert(gain, first, -np.concatenate(([0], rises[with_words][:-1])) - 1)
        # only sums matter that do not overflow: losses beyond a switch need not be told apart
        at = np.maximum(at, np.where(np.isin(np.arange(len(at)), first + np.arange(len(first))), at, -self.switch - 1))
        total = np.cumsum(at)
        rise = total - np.minimum.accumulate(total)
        starts = first + np.arange(len(first))
        pays = np.maximum.reduceat(rise, starts) > self.switch
        return best.tolist(), with_words[pays].tolist()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model from all rows with a language; counts are summed per task before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        features: dict[str, np.ndarray] = {}
        scripts: Counter = Counter()

        def fold(lang: str) -> None:
            held = features.setdefault(lang, np.zeros(FEATURES, np.int64))
            counted = words.pop(lang)
            found, of = features_of(list(counted))
            times = np.fromiter(counted.values(), np.int64, len(counted))
            held += np.bincount(found, times[of], FEATURES).astype(np.int64)
            for word, n in counted.items():
                name, letters = script_of(word.decode())
                scripts[lang, name] += letters * n

        for batch in text_batches(batches, "text"):
            for language, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                scripts[language, None] += 1  # texts
                words.setdefault(language, Counter()).update(words_of(value))
                if len(words[language]) > CACHED_WORDS:
                    fold(language)
        for language in list(words):
            fold(language)
        for language, held in features.items():
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {"lang": [language] * len(at), "script": pa.nulls(len(at), pa.string()), "feature": at.astype(np.int32), "n": held[at]}, OUT
            )
        rows = sorted(scripts.items(), key=str)
        yield pa.RecordBatch.from_pydict(
            {"lang": [k[0] for k, _ in rows], "script": [k[1] for k, _ in rows], "feature": [-1] * len(rows), "n": [n for _, n in rows]}, OUT
        )

    OUT = pa.schema([("lang", pa.string()), ("script", pa.string()), ("feature", pa.int32()), ("n", pa.int64())])
    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "lang string, script string, feature int, n bigint").groupBy("lang", "script", "feature").agg(F.sum("n").alias("n"))
    features: dict[str, np.ndarray] = {}
    scripts: dict[str, dict[str, int]] = {}
    texts: dict[str, int] = {}
    found = counted.toArrow()  # at most FEATURES rows and some scripts for each language
    for language, script, feature, n in zip(*(found.column(c).to_pylist() for c in ("lang", "script", "feature", "n")), strict=True):
        if feature >= 0:
            features.setdefault(language, np.zeros(FEATURES))[feature] = n
        elif script is None:
            texts[language] = n
        elif script:
            scripts.setdefault(language, {})[script] = n
    return Model(features, scripts, texts)


def with_language(docs: DataFrame, model: Model, text: str = "text", out: str = "language", switch: int = SWITCH) -> DataFrame:
    """``docs`` with the struct column ``out``: language, score and spans (in words); no shuffle."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    return docs.withColumn(out, text_udf(LANGUAGE, lambda: Labeller(held.value, switch))(docs[text]))
