"""Token counts of every prefix of a text, by dynamic programming over its pieces.

Byte pair encoding has two properties that make this exact. Without its last token,
the encoding of a text is that of the shorter text. And a row of tokens is the encoding of
its characters if and only if each neighbouring pair is, as a merge across a border
depends on the two tokens beside it alone. So the last token of a prefix is the only
piece that ends there and goes with the last token of what is before it, and

    count(prefix) = count(prefix without its last token) + 1,

one step per character, for all prefixes at once. Whether two tokens go together is
found by merging the two and remembered.

Texts are cut between characters that stand side by side in no piece of the vocabulary: before a
space mark that follows a letter, around characters that no piece holds, and so on. Counts of
the parts add up, so parts met before are not computed again. What is stored for a text is one
signed byte per character: by how much the count changes there (it may fall, as a longer
piece replaces several). Counts at a position, the longest prefix within a budget
and the whole count are running sums of it; nothing is encoded again.

For vocabularies with merges by score, byte fallback, a dummy space in front and no
normalisation of characters (checked on loading). Control tokens such as ``<s>`` inside a
text are ordinary characters, the library's default.

Defined cases: null and empty texts have no tokens; texts of any length are counted
whole; rows and other columns, repeated or of any name, stay as they are, and a column with the
name of a result is replaced by it; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from mailsift import session
from mailsift.llm.common import steps, text_bytes

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
KEEP_PARTS = 500_000  # parts a task remembers before it starts anew
KEEP_LENGTH = 64  # characters; longer parts are not remembered


class _Tail:
    """An end of the text read so far, the tokens that end with it (length, number, cost), the longest first,
    and where the next character leads."""

    __slots__ = ("text", "ends", "next")

    def __init__(self, text: str, ends: tuple[tuple[int, int, int], ...]):
        self.text, self.ends, self.next = text, ends, {}


class Pieces:
    """The mergeable pieces of a model, and which of them may stand side by side."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if sum(map(model.is_byte, ids)) != 256 or model.normalize("ﬁ  x ") != f"{SPACE}ﬁ{SPACE * 2}x{SPACE}":
            raise ValueError(f"{path}: needs byte fallback, a dummy space in front and no normalisation")
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        if max(map(len, self.score)) > 100:
            raise ValueError(f"{path}: a piece of more than 100 characters")
        self.starts = {piece[:n] for piece in self.score for n in range(1, len(piece))}
        self._letters = np.zeros(0x110000, np.uint16)  # a number for every character of a piece; 0 for all others
        letters = sorted({c for piece in self.score for c in piece})
        self._letters[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self._beside = np.zeros((len(letters) + 1,) * 2, bool)
        for piece in self.score:
            numbers = self._numbers(piece)
            self._beside[numbers[:-1], numbers[1:]] = True
        self.tokens, self.numbers = [""], {"": 0}  # tokens met so far, by number
        self.pairs: dict[int, bool] = {}
        self.root = _Tail("", ())
        self.tails = {"": self.root}

    def _numbers(self, text: str) -> np.ndarray:
        return self._letters[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def parts(self, text: str) -> list[str]:
        """The text cut between characters that are beside each other in no piece."""
        numbers = self._numbers(text)
        cuts = np.flatnonzero(~self._beside[numbers[:-1], numbers[1:]]) + 1
        cuts = [0, *cuts.tolist(), len(text)]
        return [text[a:b] for a, b in zip(cuts, cuts[1:])]

    def merged(self, text: str) -> list[str]:
        """Tokens of a short text: the best pair first, the leftmost of equal ones."""
        tokens, score = list(text), self.score
        while len(tokens) > 1:
            best, at = None, -1
            for i in range(len(tokens) - 1):
                value = score.get(tokens[i] + tokens[i + 1])
                if value is not None and (best is None or value > best):
                    best, at = value, i
            if at < 0:
                break
            tokens[at : at + 2] = [tokens[at] + tokens[at + 1]]
        return tokens

    def together(self, left: int, right: int) -> bool:
        """Whether two tokens are the encoding of their characters; left of a text's beginning is token 0."""
        if len(self.pairs) > 2_000_000:
            self.pairs.clear()
        left_text, right_text = self.tokens[left], self.tokens[right]
        want = [left_text, right_text] if left else [right_text]
        found = self.pairs[left << 32 | right] = self.merged(left_text + right_text) == want
        return found

    def _on(self, tail: _Tail, char: str) -> _Tail:
        """The longest end of what was read that begins a piece, one character later."""
        text = tail.text + char
        while len(text) > 1 and text not in self.starts and text not in self.score:
            text = text[1:]
        found = self.tails.get(text)
        if found is None:
            if len(self.tails) > 1_000_000:  # any characters of any script
                self.tails = {"": self.root}
                self.root.next.clear()
            ends = [text[i:] for i in range(len(text)) if i == len(text) - 1 or text[i:] in self.score]
            found = self.tails[text] = _Tail(text, tuple((len(t), self._number(t), self._cost(t)) for t in ends))
        tail.next[char] = found
        return found

    def _number(self, token: str) -> int:
        if token not in self.numbers:
            self.numbers[token] = len(self.tokens)
            self.tokens.append(token)
        return self.numbers[token]

    def _cost(self, token: str) -> int:
        return 1 if token in self.score else len(token.encode())

    def prefixes(self, part: str) -> list[int]:
        """Tokens of every prefix of a part, the empty one first."""
        tail, last, counts, known = self.root, [0], [0], self.pairs.get
        for end, char in enumerate(part, 1):
            tail = tail.next.get(char) or self._on(tail, char)
            for length, token, cost in tail.ends:
                left = last[end - length]
                fits = known(left << 32 | token)
                if fits or fits is None and self.together(left, token):
                    last.append(token)
                    counts.append(counts[end - length] + cost)
                    break
            else:
                raise AssertionError(f"no last token for {part[:end]!r}")
        return counts


class _Parts(dict):
    """Changes of the count along parts, as signed bytes."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces

    def __missing__(self, part: str) -> bytes:
        counts = self.pieces.prefixes(part)
        changes = bytes([(b - a) & 255 for a, b in zip(counts, counts[1:])])
        if len(part) <= KEEP_LENGTH:
            self[part] = changes
        return changes


class Counter:
    """Counts texts; kept while the worker lives."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        self.known = _Parts(self.pieces)

    def changes(self, text: str) -> bytes:
        """By how much the count changes at every character of the text."""
        if not text:
            return b""
        if len(self.known) > KEEP_PARTS:
            self.known.clear()
        found = b"".join(map(self.known.__getitem__, self.pieces.parts(SPACE + text.replace(" ", SPACE))))
        # The first change is that of the dummy space; the first character brings it along.
        first = np.frombuffer(found[:2], np.int8).sum(dtype=np.int8)
        return first.tobytes() + found[2:]


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def running(changes: bytes | None) -> np.ndarray:
    """Tokens of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(changes or b"", np.int8), dtype=np.int64)])


def _mapped(df: DataFrame, inputs: dict[str, Column], outputs: StructType,
            run: Callable[[pa.RecordBatch], list[pa.Array]], by: str, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the columns that ``run`` makes of the inputs, few bytes of ``by`` at a time."""
    session.tune(df.sparkSession)
    taken = {name.lower() for name in outputs.fieldNames()}
    rest = [c for c in keep or df.columns if c.lower() not in taken]
    source = df.select(
        F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("_row_there")).alias("row"),
        *[column.alias(f"in_{name}") for name, column in inputs.items()],
    )
    fields = StructType().add("row", source.schema["row"].dataType)
    for i, field in enumerate(outputs):
        fields = fields.add(f"out_{i}", field.dataType)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, f"in_{by}"):
            yield pa.RecordBatch.from_arrays([batch.column("row"), *run(batch)], fields.fieldNames())

    named = [F.col(f"out_{i}").alias(name) for i, name in enumerate(outputs.fieldNames())]
    return source.mapInArrow(go, fields).select(*[F.col(f"row.`{c}`") for c in rest], *named)


def prefix_counts(df: DataFrame, text_col: str = "text", count_col: str = "n_tokens", changes_col: str = "changes",
                  model: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with the tokens of the whole text and the change of the count at every character."""
    path = model or public_tokenizers.path(MODEL)

    def run(batch):
        found = [counter(path).changes(text) for text in batch.column("in_text").to_pylist()]
        sums = [int(np.frombuffer(changes, np.int8).sum(dtype=np.int64)) for changes in found]
        return [pa.array(sums, pa.int64()), pa.array(found, pa.binary())]

    fields = StructType().add(count_col, LongType()).add(changes_col, BinaryType())
    return _mapped(df, {"text": text_bytes(text_col)}, fields, run, "text", keep)


def count_at(df: DataFrame, n_chars: Column | int, changes_col: str = "changes", out_col: str = "n_tokens_at") -> DataFrame:
    """``df`` with the tokens of the first ``n_chars`` characters (all, if the text has fewer; null: null)."""
    n_chars = F.lit(n_chars) if isinstance(n_chars, int) else n_chars

    def run(batch):
        out = []
        for changes, n in zip(batch.column("in_changes").to_pylist(), batch.column("in_n").to_pylist()):
            out.append(None if n is None else int(np.frombuffer(changes or b"", np.int8)[: max(n, 0)].sum(dtype=np.int64)))
        return [pa.array(out, pa.int64())]

    return _mapped(df, {"changes": F.col(changes_col), "n": n_chars.cast("long")}, StructType().add(out_col, LongType()), run, "changes")


def truncate(df: DataFrame, budget: Column | int, changes_col: str = "changes", chars_col: str = "kept_chars",
             count_col: str = "kept_tokens") -> DataFrame:
    """``df`` with the length of the longest prefix of at most ``budget`` tokens, and its tokens."""
    budget = F.lit(budget) if isinstance(budget, int) else budget

    def run(batch):
        chars, counts = [], []
        for changes, most in zip(batch.column("in_changes").to_pylist(), batch.column("in_budget").to_pylist()):
            upto = running(changes)
            fits = np.flatnonzero(upto <= (-1 if most is None else most))
            chars.append(int(fits[-1]) if len(fits) else None)
            counts.append(int(upto[fits[-1]]) if len(fits) else None)
        return [pa.array(chars, pa.int64()), pa.array(counts, pa.int64())]

    fields = StructType().add(chars_col, LongType()).add(count_col, LongType())
    return _mapped(df, {"changes": F.col(changes_col), "budget": budget.cast("long")}, fields, run, "changes")


def windows(df: DataFrame, budget: int, changes_col: str = "changes", out_col: str = "ends") -> DataFrame:
    """``df`` with the ends, in characters, of consecutive pieces of a text whose counts, as read off the
    whole text's prefixes, grow by at most ``budget`` tokens each; one character at least goes into each."""
    if budget < 1:
        raise ValueError("budget must be 1 at least")
    def run(batch):
        out = []
        for changes in batch.column("in_changes").to_pylist():
            upto, ends, at = running(changes), [], 0
            while at < len(upto) - 1:
                fits = np.flatnonzero(upto[at + 1 : at + 1 + _reach(upto, at, budget)] <= upto[at] + budget)
                at += int(fits[-1]) + 1 if len(fits) else 1
                ends.append(at)
            out.append(ends)
        return [pa.array(out, pa.list_(pa.int64()))]

    return _mapped(df, {"changes": F.col(changes_col)}, StructType().add(out_col, ArrayType(LongType())), run, "changes")


def _reach(upto: np.ndarray, at: int, budget: int) -> int:
    """How far the next piece can go: once the count is 400 above the budget, no later prefix comes back below it."""
    span = 1024
    while at + span < len(upto) and upto[at + span] <= upto[at] + budget + 400:
        span *= 2
    return span
