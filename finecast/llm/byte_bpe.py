"""Byte-level BPE: merges replayed in rank order over all words of a task at once."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import cache, cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finecast.llm.shared import present

#: Words of a batch whose merges are replayed together.
TOGETHER = 1 << 20
#: Encoded words that a worker remembers, each of at most so many bytes; others are replayed again.
REMEMBERED, SHORT = 1 << 18, 64


@dataclass
class Vocabulary:
    """Ranks of a byte-level BPE; what is derived from them is built once per worker."""

    ranks: dict[bytes, int]
    pattern: str
    remembered: dict[bytes, list[int]] = field(default_factory=dict)

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "remembered": {}}

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """Rank of every pair of tokens that merges."""
        out = {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                left, right = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if left is not None and right is not None:
                    out[left, right] = rank
        return out

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """``pairs`` as sorted keys (left << 32 | right) and ranks; the last key is above all."""
        m = np.array([(a << 32 | b, r) for (a, b), r in self.pairs.items()] + [(np.iinfo(np.int64).max, -1)], np.int64)
        m = m[m[:, 0].argsort()]
        return np.ascontiguousarray(m[:, 0]), np.ascontiguousarray(m[:, 1])

    @cached_property
    def early(self) -> frozenset[int]:
        """Tokens that some pair merges away from to a lower rank than their own."""
        return frozenset(t for pair, rank in self.pairs.items() for t in pair if rank < t)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, -1 where they do not merge."""
        keys, ranks = self.table
        wanted = left << 32 | right
        at = np.searchsorted(keys, wanted)
        return np.where(keys[at] == wanted, ranks[at], -1)

    @cached_property
    def tokens(self) -> pa.Array:
        """Bytes by id; null where there is no such id."""
        out = [None] * (max(self.ranks.values(), default=-1) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return pa.array(out, pa.binary())

    @cached_property
    def bytes(self) -> np.ndarray:
        return np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    def encoded(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word; words that are a token are that token, as the ranks' own library has it."""
        if len(self.remembered) > REMEMBERED:
            self.remembered.clear()
        out = [self.remembered.get(w) or ([self.ranks[w]] if w in self.ranks else None) for w in words]
        fresh = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(fresh, replay(self, [words[i] for i in fresh]), strict=True):
            out[i] = ids
            if len(words[i]) <= SHORT:
                self.remembered[words[i]] = ids
        return out


def replay(vocabulary: Vocabulary, words: list[bytes]) -> list[list[int]]:
    """Ids of all ``words`` (none of them empty), by one replay of the merges.

    The words lie end to end, one token a byte at first.  An inverted index
    holds the places of each pair that merges, under the rank of the merge.
    Ranks come up in order; all places of a rank merge together, of pairs that
    share a token every other one from the left, and only the pairs with the two
    neighbours enter the index anew.  Places whose pair has changed since they
    were entered are skipped.

    A merge may open a lower rank than its own, in a vocabulary that lists a
    token before its parts.  Order then matters inside the word, and such a word
    is encoded ``in_turn``.
    """
    if not words:
        return []
    ends = np.cumsum([len(w) for w in words])
    tok = vocabulary.bytes[np.frombuffer(b"".join(words), np.uint8)]
    n = len(tok)
    after = np.arange(1, n + 1)
    after[ends - 1] = -1
    before = np.arange(-1, n - 1)
    before[ends[:-1]] = -1
    #: The rank of the pair that starts at each place, -1 where none merges.
    opens = np.full(n, -1)
    index: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []

    def enter(places: np.ndarray) -> None:
        ranks = opens[places]
        places, ranks = places[ranks >= 0], ranks[ranks >= 0]
        if not len(places):
            return
        order = np.argsort(ranks, kind="stable")
        places, ranks = places[order], ranks[order]
        first = np.flatnonzero(_differs(ranks))
        for rank, a, b in zip(ranks[first].tolist(), first.tolist(), [*first[1:].tolist(), len(ranks)], strict=True):
            part = places[a:b]
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(waiting, rank)

    at = np.flatnonzero(after >= 0)
    opens[at] = vocabulary.merged(tok[at], tok[at + 1])
    enter(at)
    odd: list[np.ndarray] = []
    while waiting:
        rank = heapq.heappop(waiting)
        at = np.sort(np.concatenate(index.pop(rank)))
        at = at[(opens[at] == rank) & _differs(at)]
        if not len(at):
            continue
        shares = np.concatenate([[False], after[at[:-1]] == at[1:]])
        if shares.any():
            each = np.arange(len(at))
            at = at[(each - np.maximum.accumulate(np.where(shares, 0, each))) % 2 == 0]
        gone = after[at]
        after[at] = after[gone]
        right = at[after[at] >= 0]
        if rank in vocabulary.early:
            # What the pair to the right is until its own merge of this rank.
            opened = vocabulary.merged(np.full(len(right), rank), tok[after[right]])
            odd.append(right[(opened >= 0) & (opened < rank)])
        tok[at], tok[gone], opens[at], opens[gone] = rank, -1, -1, -1
        before[after[right]] = right
        left = before[at]
        touched = np.concatenate([right, left[left >= 0]])
        opens[touched] = vocabulary.merged(tok[touched], tok[after[touched]])
        if rank in vocabulary.early:
            odd.append(touched[(opens[touched] >= 0) & (opens[touched] < rank)])
        enter(touched)

    alive = tok >= 0
    upto = np.concatenate([[0], np.cumsum(alive)[ends - 1]]).tolist()
    ids = tok[alive].tolist()
    out = [ids[a:b] for a, b in zip(upto, upto[1:], strict=False)]
    for i in np.unique(np.searchsorted(ends, np.concatenate(odd), "right")).tolist() if odd else ():
        out[i] = in_turn(vocabulary, words[i])
    return out


def _differs(x: np.ndarray) -> np.ndarray:
    """Where a sorted array differs from the value before."""
    return np.concatenate([np.ones(min(len(x), 1), bool), x[1:] != x[:-1]])


def in_turn(vocabulary: Vocabulary, word: bytes) -> list[int]:
    """Ids of one word, merge by merge: always the lowest rank, leftmost first."""
    tok = vocabulary.bytes[np.frombuffer(word, np.uint8)].tolist()
    after, before = [*range(1, len(tok)), -1], list(range(-1, len(tok) - 1))
    opens = [vocabulary.pairs.get((a, b), -1) for a, b in zip(tok, tok[1:], strict=False)] + [-1]
    waiting = [(rank, i) for i, rank in enumerate(opens) if rank >= 0]
    heapq.heapify(waiting)
    while waiting:
        rank, i = heapq.heappop(waiting)
        if opens[i] != rank:
            continue
        gone = after[i]
        tok[i], tok[gone], opens[i], opens[gone], after[i] = rank, -1, -1, -1, after[gone]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0:
                opens[a] = vocabulary.pairs.get((tok[a], tok[after[a]]), -1)
                if opens[a] >= 0:
                    heapq.heappush(waiting, (opens[a], a))
    return [t for t in tok if t >= 0]


def load(path: str, pattern: str) -> Vocabulary:
    """Ranks from a file of lines ``base64 rank``; read where the job is stated, so executors need no copy."""
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}, pattern)


@cache
def _ranges(kind: str) -> str:
    """Code points of a class as ranges of a Java class."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = (m.group() for m in regex.finditer(rf"\p{{{kind}}}+", every))
    return "".join(rf"\x{{{ord(m[0]):x}}}-\x{{{ord(m[-1]):x}}}" for m in found)


def words_of(text: Column, pattern: str) -> Column:
    """array<string>: matches of ``pattern`` in each text.

    Matching runs in the JVM, where white space has to be told to be Unicode's.
    Texts with code points that the JVM's Unicode tables don't know yet use the
    pattern with letters and numbers written out.
    """
    full = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_ranges('L')}{_ranges('N')}]").replace(r"\p{L}", f"[{_ranges('L')}]").replace(r"\p{N}", f"[{_ranges('N')}]")
    known = F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))
    return F.when(text.rlike(r"\p{Cn}"), F.regexp_extract_all(text, F.lit("(?U)" + full), F.lit(0))).otherwise(known)


def _cuts(sizes: np.ndarray, most: int) -> Iterable[tuple[int, int]]:
    """Consecutive rows, (start, number), whose sizes add up to about ``most``; a larger row stands alone."""
    group = (np.cumsum(sizes) - sizes) // most
    edges = np.flatnonzero(np.diff(group)) + 1
    starts = [0, *edges.tolist()]
    return zip(starts, np.diff([*starts, len(sizes)]).tolist(), strict=True)


def _row_ids(vocabulary: Vocabulary, words: pa.Array) -> pa.Array:
    """list<int> of ids for a list<string> of words."""
    held = words.flatten().cast(pa.binary()).dictionary_encode()
    ids = vocabulary.encoded(held.dictionary.to_pylist())
    ends = np.zeros(len(ids) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, ids), np.int32, len(ids)), out=ends[1:])
    known = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])))
    taken = known.take(held.indices)
    upto = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy(zero_copy_only=False))])
    rows = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(upto[rows].astype(np.int32)), taken.flatten())


def _row_bytes(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    """binary of the tokens for a list<int> of ids."""
    flat, tokens = ids.flatten(), vocabulary.tokens
    known = pc.all(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))).as_py() is not False and not flat.null_count
    taken = tokens.take(flat) if known else None
    if taken is None or taken.null_count:
        raise ValueError("the vocabulary lacks an id")
    upto = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False))])
    rows = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])
    return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(upto[rows].astype(np.int32)), taken.buffers()[2]])


def _in_pieces(lists: pa.Array, of, kind: pa.DataType) -> pa.Array:
    """``of`` for a few lists at a time, so that Python holds one piece's working memory."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    parts = [of(lists.slice(at, n)) for at, n in _cuts(sizes, TOGETHER)] if len(lists) else []
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "bpe_ids", decoded: str | None = None) -> DataFrame:
    """Every row of ``docs`` with the token ids of its whole text, array<int>, under ``ids``.

    With ``decoded`` also the bytes that these ids stand for, binary, as
    ``decode`` gives them, in the same pass.  Columns of these names are
    replaced, all others stay.

    Texts are cut by the vocabulary's pattern; each word is encoded by itself,
    without special tokens.  The different words of about ``TOGETHER`` words in
    a batch are replayed together (see ``replay``), and a worker remembers what
    it has encoded, within ``REMEMBERED``.  No row meets another: nothing is
    shuffled, and the ranks are the only thing sent along (their size is that
    of the vocabulary, whatever the corpus).  Null and empty texts have no ids;
    repeated rows get equal ids; an empty table gives no rows.  A very long text
    is replayed by itself, in time in proportion to its length times a logarithm.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    listed = pa.list_(pa.int32())

    @F.arrow_udf("array<int>")
    def coded(words: pa.Array) -> pa.Array:
        return _in_pieces(words, lambda x: _row_ids(shared.value, x), listed)

    @F.arrow_udf("i array<int>, d binary")
    def both(words: pa.Array) -> pa.Array:
        def piece(x: pa.Array) -> pa.Array:
            out = _row_ids(shared.value, x)
            return pa.StructArray.from_arrays([out, _row_bytes(shared.value, out)], names=["i", "d"])

        return _in_pieces(words, piece, pa.struct([("i", listed), ("d", pa.binary())]))

    words = words_of(present(F.col(text)), vocabulary.pattern)
    if decoded is None:
        return docs.withColumn(ids, coded(words))
    held = docs.withColumn(ids, both(words))
    return held.withColumns({decoded: F.col(ids)["d"], ids: F.col(ids)["i"]})


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "bpe_ids", out: str = "bpe_bytes") -> DataFrame:
    """Every row of ``rows`` with the bytes of its ids, binary, under ``out`` (replacing a column of that name).

    No ids and null give no bytes; an id that the vocabulary lacks fails the job.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def read(lists: pa.Array) -> pa.Array:
        return _in_pieces(lists, lambda x: _row_bytes(shared.value, x), pa.binary())

    return rows.withColumn(out, read(F.coalesce(F.col(ids), F.array().cast("array<int>"))))


def bpe_report(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per input row: id, number of tokens, digests of the ids and of the bytes they decode to."""
    coded = encode(docs.select("doc_id", "text"), vocabulary, decoded="bpe_bytes")
    return coded.select(
        "doc_id", F.size("bpe_ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("bpe_ids", " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("bpe_bytes", 256).alias("decoded_sha256"),
    )
