"""Token counts by a compiled tokenizer: a deterministic transducer with emitted counts.

A BPE model (sentencepiece file) is compiled, transition by transition as texts need
them, into a machine that reads characters. After each character the tokenization of
what was read so far ends in exactly one token, the one that may follow the last token
of the text before it; so a state holds, for every suffix that may still grow into a
token, the token that ends before it and the difference in tokens. A transition emits
how many tokens the text gained (a merge of earlier ones may make it zero or less), and
the sum over a text is its number of tokens, whatever follows.

Between two characters that stand together in no token the machine is back in its start
state. The map of a chunk that starts there, (exit state, emitted), does not depend on
what came before; equal chunks share one map. The maps of a batch of texts compose by
a prefix sum over their chunks; a run without such a place is cut into parts whose maps
(entry state -> exit state, emitted) are composed in order.

Defined results: a null or empty text has no token; special strings in a text are plain
text, as the library has it; equal texts have equal counts. Other columns pass through;
an existing column named like the output is replaced.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from variantlake.llm.common import text_udf

#: characters of one part of a run that holds no place to start anew
PART = 64
#: entries of a task's memories of chunks, and of states; each starts anew beyond, without effect on results
CACHED = 300_000
SPACE = "▁"
COUNTS = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])


class CountingTransducer:
    """Counts tokens character by character; transitions are compiled when first taken."""

    def __init__(self, model_path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.model = model
        ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        pieces = [model.id_to_piece(i) for i in ids]
        #: pieces that merging ever arrives at
        self.pieces = {p for p in pieces if "\n" not in p and self._tokens(p) == [p]}
        self.live = {p[:n] for p in self.pieces for n in range(1, len(p))}
        self.together = {p[i : i + 2] for p in self.pieces for i in range(len(p) - 1)}
        if any(pair[1] == SPACE and pair[0] != SPACE for pair in self.together) or any("\n" in p for p in pieces):
            raise ValueError("tokens reach across a word's start or a line's end")
        self.characters = {p for p in self.pieces if len(p) == 1}
        self.chunks: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        """Forget the compiled states."""
        #: state 0: nothing pending, and any token may follow
        self.states: dict[tuple, int] = {("", ((0, "", 0),)): 0}
        self.held: list[tuple] = [("", ((0, "", 0),))]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.allowed: dict[tuple[str, str], bool] = {}
        self.singles: dict[str, int] = {}
        self.parts: dict[tuple[int, str], tuple[int, int]] = {}

    def _tokens(self, text: str) -> list[str]:
        """Tokens of ``text`` alone: after a line end, with which no token merges."""
        return self.model.encode("\n" + text, out_type=str)[2:]

    def _may_follow(self, token: str, last: str) -> bool:
        """Whether ``last`` then ``token`` are the tokens of their joined text."""
        if not last or last[-1] + token[0] not in self.together:
            return True
        found = self.allowed.get((last, token))
        if found is None:
            found = self.allowed[last, token] = self._tokens(last + token) == [last, token]
        return found

    def _compile(self, state: int, character: str) -> tuple[int, int]:
        pending, starts = self.held[state]
        if character not in self.characters:  # bytes, which nothing merges with
            move = 0, len(character.encode())
        else:
            n = len(pending)
            last, emitted = next(
                (token, gained + 1)
                for back, before, gained in starts
                if (token := pending[n - back :] + character) in self.pieces and self._may_follow(token, before)
            )
            text = pending + character
            kept = [(back + 1, before, gained - emitted) for back, before, gained in starts if text[n - back :] in self.live]
            longest = kept[0][0] if kept else 0
            key = text[len(text) - longest :], (*kept, (0, last, 0))
            if key not in self.states:
                self.states[key] = len(self.held)
                self.held.append(key)
                self.moves.append({})
            move = self.states[key], emitted
        self.moves[state][character] = move
        return move

    def run(self, state: int, text: str) -> tuple[int, int]:
        """(exit state, emitted) of ``text`` from ``state``."""
        total, moves = 0, self.moves
        for character in text:
            state, emitted = moves[state].get(character) or self._compile(state, character)
            total += emitted
        return state, total

    def of_chunk(self, chunk: str) -> int:
        """Tokens of a chunk that begins in the start state.

        Characters at its end that are in no token with the one before them (often a mark
        after a word, or all of a run that nothing merges) start anew, one by one.
        """
        end, total = len(chunk), 0
        while end > 1 and chunk[end - 1] != SPACE and chunk[end - 2 : end] not in self.together:
            end -= 1
            last = chunk[end]
            if last not in self.singles:
                self.singles[last] = self.run(0, last)[1]
            total += self.singles[last]
        head = chunk[:end]
        if end <= PART:
            return total + self._count(head) if total else self.run(0, head)[1]
        state = 0
        for at in range(0, end, PART):  # maps of the parts, composed in order
            part = state, head[at : at + PART]
            if part not in self.parts:
                self.parts[part] = self.run(*part)
            state, emitted = self.parts[part]
            total += emitted
        return total

    def _count(self, chunk: str) -> int:
        found = self.chunks.get(chunk)
        if found is None:
            found = self.of_chunk(chunk)
            if len(chunk) <= PART:  # longer ones rarely come again; their parts are remembered
                self.chunks[chunk] = found
        return found

    #: words with the spaces before them, spaces at an end, line ends: each begins in the start state
    CHUNK = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def __call__(self, texts: list[str]) -> np.ndarray:
        """Number of tokens of each text."""
        if len(self.chunks) > CACHED:
            self.chunks = {}
        if max(len(self.held), len(self.parts), len(self.allowed)) > CACHED:
            self._reset()
        known, emitted, ends = self.chunks, [], [0]
        for text in texts:
            if text:
                found = self.CHUNK.findall(SPACE + text.replace(" ", SPACE))
                long = {}
                for chunk in set(found).difference(known):
                    n = self._count(chunk)
                    if chunk not in known:
                        long[chunk] = n
                emitted += (long.get(c) or known[c] for c in found) if long else map(known.__getitem__, found)
            ends.append(len(emitted))
        return np.diff(np.concatenate(([0], np.cumsum(np.array(emitted, np.int64))))[ends])


def with_token_counts(docs: DataFrame, model_path: str, text: str = "text", out: str = "tokens") -> DataFrame:
    """``docs`` with the struct column ``out``: UTF-8 bytes and tokens of each whole text; no shuffle."""

    def make():
        count = CountingTransducer(model_path)
        return lambda texts: [[len(t.encode()) if t else 0 for t in texts], count([t or "" for t in texts]).tolist()]

    return docs.withColumn(out, text_udf(COUNTS, make)(docs[text]))
