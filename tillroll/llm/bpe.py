"""Byte-level BPE encoding and decoding, exact to the tokenizer file's own library.

Text over BRANCH characters is encoded by tree concatenation: its halves, cut anywhere, are encoded on
their own, down to the leaves; then, level by level, a window around each join is encoded again with the
pre-tokenizer, and grown until both sides agree. It reaches from the SPARE-th safe cut before the
join to the SPARE-th after it. A safe cut is a place that the pattern parts in any text: before a
space or line feed that follows something visible, or between a letter and a punctuation mark. The
sides agree if the cuts are edges of tokens in both halves, and the first and the last fresh token are
those that the halves had there. A window that covers both halves is simply their encoding.

A run of over LONG bytes that the pattern leaves unsplit is the special case of one piece: its
halves, down to LEAF bytes, are encoded in parallel by the library's batch call, and windows grow until
their first and last token agree with both sides. A BPE encoding is right exactly if all
neighbouring tokens are, and those agreeing tokens have the right neighbours on either side.

Scale: both directions are projections without a shuffle. Texts pass through Python in Arrow
batches, and out again in slices, so memory follows the longest text and not the batch.

Defined cases: NULL and empty texts give no tokens; a NULL list decodes to NULL. Special tokens
found in a text get their ids. Bytes that form no character decode to U+FFFD. Rows are
independent, so ties, repeated rows and empty tables need no rule; all columns stay.
"""

from __future__ import annotations

import codecs
import json
import re
from collections.abc import Callable, Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillroll.llm.common import ship, unused_name

ship(__name__)

BRANCH = 4096
REACH = 64
SPARE = 2
LONG = 1024
LEAF = 512
WINDOW = 4
SLICE = 256
PIECE = 1 << 20
# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies, back to the byte.

    Visible Latin-1 letters stand for themselves, the rest for letters from 256 on.
    """
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(byte): byte for byte in visible} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


class Codec:
    """One byte-level BPE tokenizer, from its JSON text."""

    def __init__(self, text: str):
        self.text, given = text, json.loads(text)
        model, special = given["model"], {token["content"]: token["id"] for token in given["added_tokens"]}
        letters, vocabulary = _byte_letters(), model["vocab"]
        pairs = [merge if isinstance(merge, list) else merge.split(" ") for merge in model["merges"]]
        order = [vocabulary["".join(pair)] for pair in pairs]
        if order != sorted(order) or given["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        }:
            raise ValueError("not a byte-level BPE tokenizer whose ids follow its merges")
        self.special = special
        self.letters = {i: token for token, i in vocabulary.items() if token not in special}
        as_bytes = {letter: bytes([byte]) for letter, byte in letters.items()}
        ranks = {b"".join(map(as_bytes.__getitem__, token)): i for i, token in self.letters.items()}
        self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_str(self.text)

    @cached_property
    def plain(self) -> Tokenizer:
        """The merges alone: without a pre-tokenizer, text stays in one piece."""
        return Tokenizer(self.whole.model)

    def encode(self, text: str) -> np.ndarray:
        found = [self._encode_tree(piece) for piece in _pieces(text)]
        return found[0] if len(found) == 1 else np.concatenate([np.empty(0, np.uint32), *found])

    @cached_property
    def sizes(self) -> np.ndarray:
        """The bytes of each token."""
        sizes = np.zeros(self.fast.n_vocab, np.int64)
        for token, i in self.special.items():
            sizes[i] = len(token.encode())
        for i, token in self.letters.items():
            sizes[i] = len(token)
        return sizes

    @cached_property
    def whole_specials(self) -> bool:
        """No special token could be cut by a safe cut."""
        return not any(_SAFE.search(token) for token in self.special)

    def _encode_tree(self, text: str) -> np.ndarray:
        if len(text) <= BRANCH or not self.whole_specials:
            return self._encode_piece(text)
        left, right = text[: len(text) // 2], text[len(text) // 2 :]
        return self.concatenate(left, self._encode_tree(left), right, self._encode_tree(right))

    def concatenate(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """The tokens of two neighbouring stretches of text, as if encoded in one."""
        reach = REACH
        while reach < max(len(left), len(right)):
            near = max(0, len(left) - reach)
            before = [cut.end() for cut in _SAFE.finditer(left, near)][-SPARE:]
            after = [cut.end() for cut in islice(_SAFE.finditer(right, 0, reach), SPARE)]
            if len(before) == len(after) == SPARE:
                start, end = before[0], after[-1]
                i = len(left_ids) - _tokens_over(self.sizes[left_ids[-4 * reach :]][::-1], len(left[start:].encode()))
                j = _tokens_over(self.sizes[right_ids[: 4 * reach]], len(right[:end].encode()))
                fresh = self._encode_piece(left[start:] + right[:end])
                if 0 <= i <= len(left_ids) and j >= 0 and fresh[0] == left_ids[i] and fresh[-1] == right_ids[j - 1]:
                    return np.concatenate([left_ids[:i], fresh, right_ids[j:]])
            reach *= 2
        return self._encode_piece(left + right)

    def _encode_piece(self, text: str) -> np.ndarray:
        if not _has_unsplit(text):
            return self.fast.encode_to_numpy(text, allowed_special="all")
        ids: list[int] = []
        for part in self._around_special(text):
            ids += [self.special[part]] if part in self.special else self._encode_unsplit(part)
        return np.array(ids, dtype=np.uint32)

    def _around_special(self, text: str) -> list[str]:
        if not self.special:
            return [text]
        pattern = "|".join(re.escape(token) for token in sorted(self.special, key=len, reverse=True))
        return [part for part in re.split(f"({pattern})", text) if part]

    def _encode_unsplit(self, text: str) -> list[int]:
        split = [piece for piece, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)]
        leaves = [leaf for piece in split for leaf in (_halves(piece) if len(piece) > LONG else [piece])]
        tokens = iter([found.ids for found in self.plain.encode_batch(leaves, add_special_tokens=False)])
        ids: list[int] = []
        for piece in split:
            ids += self._joined(piece, tokens) if len(piece) > LONG else next(tokens)
        return ids

    def _joined(self, piece: str, tokens: Iterator[list[int]]) -> list[int]:
        if len(piece) <= LEAF:
            return next(tokens)
        middle = len(piece) // 2
        left = self._joined(piece[:middle], tokens)
        return self.join(left, self._joined(piece[middle:], tokens))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The tokens of two neighbouring stretches of one unsplit piece, as if encoded in one."""
        reach = WINDOW
        while True:
            inner, outer = left[-reach:], right[:reach]
            window = "".join(self.letters[i] for i in [*inner, *outer])
            ids = self.plain.encode(window, add_special_tokens=False).ids
            left_agrees = reach >= len(left) or ids[0] == inner[0]
            right_agrees = reach >= len(right) or ids[-1] == outer[-1]
            if left_agrees and right_agrees:
                return left[:-reach] + ids + right[reach:]
            reach *= 2

    def decode(self, ids: np.ndarray) -> str:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        parts = [
            decoder.decode(self.fast.decode_bytes(ids[start : start + PIECE].tolist()))
            for start in range(0, len(ids), PIECE)
        ]
        return "".join([*parts, decoder.decode(b"", True)])


def _tokens_over(sizes: np.ndarray, size: int) -> int:
    """How many of the tokens have `size` bytes together; -1 if there is no edge of a token."""
    ends = np.cumsum(sizes)
    place = int(np.searchsorted(ends, size))
    return place + 1 if place < len(ends) and ends[place] == size else -(1 << 62)


def _halves(piece: str) -> list[str]:
    if len(piece) <= LEAF:
        return [piece]
    middle = len(piece) // 2
    return _halves(piece[:middle]) + _halves(piece[middle:])


# Each match ends at a cut; see above. Letters of scripts that put no spaces between words are among them.
_SAFE = re.compile(r"\S(?=[ \n])|[A-Za-z\u3041-\u3096\u4E00-\u9FFF](?=[,.;:!?\u3001\u3002\uFF0C\uFF01\uFF1F])")
# The pattern never joins a visible character to white space after it, so a text can be cut there.
_CUT = re.compile(r"(?<=[!-~])[ \n]")


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE:
        cut = _CUT.search(text, start + PIECE)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def _has_unsplit(text: str) -> bool:
    """Whether there may be a run of over LONG bytes that the pattern doesn't split."""
    if len(text) * 4 <= LONG:
        return False
    words = text.split()
    blank = len(text) - sum(map(len, words)) - len(words)
    return blank > LONG // 4 or max(map(len, words), default=0) > LONG // 4


def load(path: str) -> str:
    """The tokenizer file's text, read once on the driver and sent with each task."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _with_columns(
    frame: DataFrame, source: str, into: dict[str, str], keep: list[str] | None, work: Callable
) -> DataFrame:
    """`frame` with last columns (name to type) worked out from `source`, in bounded slices."""
    names = frame.columns if keep is None else keep
    # Python sees numbered columns, so that those of the frame can have any names.
    same = [F.col(f"`{name}`").alias(f"kept_{i}") for i, name in enumerate(names)]
    rows = frame.select(*same, F.col(f"`{source}`").alias("given"))
    made = [F.lit(None).cast(kind).alias(f"made_{i}") for i, kind in enumerate(into.values())]
    fields = frame.select(*same, *made).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = work()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                *kept, values = batch.slice(start, SLICE).columns
                yield pa.RecordBatch.from_arrays([*kept, *compute(values)], names=fields.names)

    return rows.mapInArrow(run, fields).toDF(*names, *(unused_name(names, name) for name in into))


def _encoded(codec: Codec, texts: pa.Array) -> list[np.ndarray]:
    return [codec.encode(text or "") for text in texts.to_pylist()]


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    ids = np.concatenate([np.empty(0, np.uint32), *found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


def encode(
    docs: DataFrame, path: str, text: str = "text", into: str = "ids", keep: list[str] | None = None
) -> DataFrame:
    """`docs` (or its columns in `keep`) with the token ids of `text` as a last column."""
    tokenizer = load(path)

    def work():
        codec = Codec(tokenizer)
        return lambda texts: [_id_lists(_encoded(codec, texts))]

    return _with_columns(docs, text, {into: "array<int>"}, keep, work)


def decode(
    tokens: DataFrame, path: str, ids: str = "ids", into: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """`tokens` (or its columns in `keep`) with the text of `ids` as a last column."""
    tokenizer = load(path)

    def work():
        codec = Codec(tokenizer)

        def one(ids: pa.ListScalar) -> str | None:
            return codec.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else None

        return lambda lists: [pa.array([one(ids) for ids in lists], pa.string())]

    return _with_columns(tokens, ids, {into: "string"}, keep, work)


def round_trip(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`decode` after `encode`, as columns `ids` and `decoded`, in one Python worker per task."""
    tokenizer = load(path)

    def work():
        codec = Codec(tokenizer)

        def both(texts: pa.Array) -> list[pa.Array]:
            found = _encoded(codec, texts)
            return [_id_lists(found), pa.array([codec.decode(ids) for ids in found], pa.string())]

        return both

    return _with_columns(docs, text, {"ids": "array<int>", "decoded": "string"}, keep, work)
