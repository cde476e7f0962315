"""Secret scans by grammar inference.

Three base patterns find labelled credentials. From a bounded sample of them a prefix
tree per kind is built, and states whose continuations do not differ significantly
(Hoeffding bound) are merged into a small probabilistic automaton. Every candidate of
every text, a maximal run of credential characters, is then scored by its likelihood
under each kind's automaton; it is reported where it fits about as well as the labelled
credentials do and better than ordinary runs, a model of which is sampled alike.

Sample bounds: ``SAMPLE`` distinct credentials of each kind and ``SAMPLE`` ordinary runs
(one offered by each text), those with the least hashes over all texts. The scan itself
covers whole texts. Defined results: a null text counts as empty; equal texts give equal
spans; a text without a match has no span; with no labelled credential at all (or an
empty table) only base spans are found. Other columns pass through; an existing column
named like the output is replaced. Overlapping candidates of base spans are left out.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantlake.llm.common import text_udf, written

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so shorter ones need not be matched
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}

SAMPLE = 1500
#: significance of a difference between two states
ALPHA = 0.05
#: a candidate must be as likely, per character, as all but this share of the labelled ones
MISSED = 0.02
#: and so many bits per character likelier than an ordinary run
MARGIN_BITS = 0.5
SMOOTHING = 0.5
CACHED_CANDIDATES = 200_000

#: characters are told apart by class; punctuation stands for itself
CLASS = str.maketrans(
    {c: s for chars, s in (("abcdef", "a"), ("ghijklmnopqrstuvwxyz", "g"), ("ABCDEF", "A"), ("GHIJKLMNOPQRSTUVWXYZ", "G"), ("0123456789", "0")) for c in chars}
)
SYMBOLS = "agAG0+/_.=-"

SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
SECRETS = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("learned", T.ArrayType(SPAN))])


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, kind's rank, end, credential) of the base patterns, by start, then kind."""
    out = []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                out.append((m.start(), 0, m.end(), m[2]))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def ordinary(text: str, base: list[tuple]) -> list[tuple[int, int]]:
    """Candidates that no base span overlaps."""
    found = [(m.start(), m.end()) for m in CANDIDATE.finditer(text)]
    if not base or not found:
        return found
    out, at = [], 0
    held = sorted((s, e) for s, _, e, _ in base)
    reach = 0
    for start, end in found:
        while at < len(held) and held[at][0] < end:
            reach = max(reach, held[at][1])
            at += 1
        if reach <= start:
            out.append((start, end))
    return out


class Automaton:
    """A probabilistic automaton merged from the prefix tree of ``words``."""

    def __init__(self, words: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [defaultdict(int)]
        self.ended, self.reached = [0], [0]
        for word in words:
            state = 0
            self.reached[0] += 1
            for symbol in word:
                self.seen[state][symbol] += 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.seen.append(defaultdict(int))
                    self.ended.append(0)
                    self.reached.append(0)
                state = self.next[state][symbol]
                self.reached[state] += 1
            self.ended[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.red = [0]
        self._merge()
        self.log = [self._logs(state) for state in range(len(self.next))]

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > (math.sqrt(1 / n) + math.sqrt(1 / m)) * self.bound

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.reached[a], self.reached[b]
            if not n or not m:
                continue
            if self._differ(self.ended[a], n, self.ended[b], m):
                return False
            for symbol in self.seen[a].keys() | self.seen[b].keys():
                if self._differ(self.seen[a].get(symbol, 0), n, self.seen[b].get(symbol, 0), m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.reached[a] += self.reached[b]
            self.ended[a] += self.ended[b]
            for symbol, n in self.seen[b].items():
                self.seen[a][symbol] += n
            for symbol, below in self.next[b].items():
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], below))
                else:
                    self.next[a][symbol] = below

    def _merge(self) -> None:
        """Visit the states next to the accepted ones; merge each into a compatible one, or accept it."""
        done = set(self.red)
        while True:
            edge = next(((q, s, r) for q in self.red for s, r in sorted(self.next[q].items()) if r not in done), None)
            if edge is None:
                return
            q, symbol, blue = edge
            for red in self.red:
                if self._compatible(red, blue):
                    self.next[q][symbol] = red
                    self._fold(red, blue)
                    break
            else:
                self.red.append(blue)
                done.add(blue)

    def _logs(self, state: int) -> dict[str, float]:
        total = self.reached[state] + SMOOTHING * (len(SYMBOLS) + 1)
        logs = {s: math.log2((self.seen[state].get(s, 0) + SMOOTHING) / total) for s in SYMBOLS}
        return logs | {"": math.log2((self.ended[state] + SMOOTHING) / total)}

    def bits(self, word: str) -> float:
        """Mean log2 likelihood of a symbol of ``word``, its end included; an unseen symbol leads back to the start."""
        state, total = 0, 0.0
        for symbol in word:
            total += self.log[state][symbol]
            state = self.next[state].get(symbol, 0)
        return (total + self.log[state][""]) / (len(word) + 1)


class Formats:
    """An automaton and a least likelihood per kind, and a model of ordinary runs."""

    def __init__(self, labelled: dict[str, list[str]], plain: list[str], alpha: float = ALPHA, missed: float = MISSED):
        self.kinds = {}
        for kind in KINDS:
            if words := sorted(w.translate(CLASS) for w in labelled.get(kind, [])):
                automaton = Automaton(words, alpha)
                scores = sorted(map(automaton.bits, words))
                self.kinds[kind] = automaton, scores[int(missed * (len(scores) - 1))]
        pairs: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        for word in plain:
            word = word.translate(CLASS)
            for a, b in zip(" " + word, word + " ", strict=True):
                pairs[a][b] += 1
        self.plain = {}
        for a in " " + SYMBOLS:
            total = sum(pairs[a].values()) + SMOOTHING * (len(SYMBOLS) + 1)
            self.plain[a] = {b: math.log2((pairs[a][b] + SMOOTHING) / total) for b in " " + SYMBOLS}

    def kind(self, run: str) -> str | None:
        """The kind that ``run`` fits best, if it fits any."""
        word = run.translate(CLASS)
        usual = sum(self.plain[a][b] for a, b in zip(" " + word, word + " ", strict=True)) / (len(word) + 1)
        best, found = usual + MARGIN_BITS, None
        for kind, (automaton, least) in self.kinds.items():
            if (bits := automaton.bits(word)) >= least and bits > best:
                best, found = bits, kind
        return found


def learn_formats(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Formats:
    """Formats of the credentials that the base patterns find in ``docs`` (bounded sample, see above)."""
    fields = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "value")])
    offered = T.StructType([T.StructField("offered", T.ArrayType(fields))])

    def make():
        def offer(texts: list) -> list:
            out = []
            for t in texts:
                base = base_spans(t or "")
                rows = [{"kind": KINDS[rank], "value": value} for _, rank, _, value in base]
                if runs := ordinary(t or "", base):
                    least = min((t[a:b] for a, b in runs), key=lambda r: (xxhash.xxh3_64_intdigest(r), r))
                    rows.append({"kind": "", "value": least})
                out.append(rows)
            return [out]

        return offer

    found = docs.select(F.explode(text_udf(offered, make)(docs[text])["offered"]).alias("o")).select("o.kind", "o.value")
    found = written(found.groupBy("kind", "value").agg(F.xxhash64("value").alias("order")), "offered")
    labelled: dict[str, list[str]] = {}
    parts = [found.where(F.col("kind") == kind).orderBy("order", "value").limit(sample) for kind in ("", *KINDS)]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    for row in merged.collect():  # at most ``sample`` rows of each kind
        labelled.setdefault(row["kind"], []).append(row["value"])
    return Formats(labelled, sorted(labelled.pop("", [])))


def with_secrets(docs: DataFrame, formats: Formats, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with the struct column ``out``: base spans and the spans that fit a learned format (code points, end exclusive)."""

    def make():
        known: dict[str, str | None] = {}

        def scan(texts: list) -> list:
            bases, learned = [], []
            for t in texts:
                base = base_spans(t or "")
                bases.append([{"kind": KINDS[rank], "start": start, "end": end} for start, rank, end, _ in base])
                spans = []
                for start, end in ordinary(t or "", base) if formats.kinds else ():
                    run = t[start:end]
                    if run not in known:
                        if len(known) >= CACHED_CANDIDATES:
                            known.clear()
                        known[run] = formats.kind(run)
                    if known[run]:
                        spans.append({"kind": f"like_{known[run]}", "start": start, "end": end})
                learned.append(spans)
            return [bases, learned]

        return scan

    return docs.withColumn(out, text_udf(SECRETS, make)(docs[text]))


def redacted(docs: DataFrame, formats: Formats, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret span of ``text`` replaced by ``mask`` (overlapping spans by one)."""

    def make():
        def redact(texts: list) -> list:
            out = []
            for t in texts:
                base = base_spans(t) if t else []
                spans = [(s, e) for s, _, e, _ in base]
                if t and formats.kinds:
                    spans += [(s, e) for s, e in ordinary(t, base) if formats.kind(t[s:e])]
                parts, at = [], 0
                for start, end in sorted(spans):
                    if start >= at:
                        parts += [t[at:start], mask]
                    at = max(at, end)
                out.append("".join([*parts, t[at:]]) if parts else t)
            return [out]

        return redact

    return docs.withColumn(text, text_udf(T.StructType([T.StructField("text", T.StringType())]), make)(docs[text])["text"])
