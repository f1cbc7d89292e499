"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 8).

A run of documents is split by the pattern, and its distinct pieces are laid
out in one array of byte tokens.  An inverted index keeps, for each token pair
(named by the rank it merges into), the positions where it stands.  Merges are
applied in rank order; each touches the positions of its pair, in every piece at
once, and only the pairs with the two neighbours are looked up again.  A piece
that holds a pair more than once merges the leftmost first, as the ranks' own
library does, and a rank that appears below the current one is taken up next.

A run is bounded by bytes, and the pieces of a document are streamed through a
table of distinct pieces, so memory is bounded by the run and the longest text.

Edge cases: a null text is the empty text, with no tokens and the digest of
the empty string; no rows give no rows; ids and columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import Numbers, byte_batches, table, texts

RUN_BYTES = 32 << 20
NO_RANK = np.int32(2**31 - 1)
_READY: dict = {}


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class Replay:
    """Merge replay for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = {r: t for t, r in ranks.items()}
        self.bytes_to_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(rank)
        keys, merged = np.array(keys, np.int64), np.array(merged, np.int32)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], merged[order]

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), NO_RANK, np.int32)
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.merged[at], NO_RANK)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in one array, and the number of ids of each piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        n = len(raw)
        token = self.bytes_to_id[raw]
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        after = np.arange(1, n + 2, dtype=np.int32)
        before = np.arange(-1, n, dtype=np.int32)
        if n:
            last = piece[1:] != piece[:-1]
            after[:n - 1][last] = n
            after[n - 1] = n
            before[1:n][last] = -1
        alive = np.ones(n, bool)
        pair = np.full(n + 1, NO_RANK, np.int32)  # the rank into which a position and its right neighbour merge
        index: dict[int, list[np.ndarray]] = {}
        pending: list[int] = []

        def enter(at: np.ndarray) -> None:
            at = at[after[at] < n]
            r = self.rank_of(token[at], token[after[at]])
            pair[at] = r
            has = r < NO_RANK
            if not has.any():
                return
            at, r = at[has], r[has]
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            starts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
            for rank, part in zip(r[starts].tolist(), np.split(at, starts[1:]) if len(starts) > 1 else [at]):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(pending, rank)

        enter(np.arange(n, dtype=np.int32))
        while pending:
            rank = heapq.heappop(pending)
            at = index.pop(rank)
            at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
            at = at[alive[at] & (pair[at] == rank)]
            if not len(at):
                continue
            first = np.ones(len(at), bool)
            first[1:] = piece[at[1:]] != piece[at[:-1]]
            if not first.all():  # the leftmost in each piece now, the rest of them in the next turn
                index[rank] = [at[~first]]
                heapq.heappush(pending, rank)
                at = at[first]
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            pair[at] = pair[gone] = NO_RANK
            right = after[gone]
            after[at] = right
            has_right = right < n
            before[right[has_right]] = at[has_right]
            left = before[at]
            left = left[left >= 0]
            pair[left] = NO_RANK
            enter(np.concatenate((left, at)))
        return token[alive], np.bincount(piece[alive], minlength=len(pieces))


def _replay(ranks_file: bytes) -> Replay:
    key = hashlib.sha256(ranks_file).digest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = Replay(read_ranks(ranks_file))
    return _READY[key]


def encode_run(replay: Replay, pattern, data: list[bytes]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """The pieces of each text as numbers of distinct pieces, the ids of all distinct pieces, and how many each has."""
    numbers = Numbers()
    split = [list(map(numbers.__getitem__, pattern.findall(text.decode()))) for text in data]
    ids, counts = replay.encode([p.encode() for p in numbers])
    return split, ids, counts


def encode_texts(docs: DataFrame, ranks_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(ranks_file)  # a vocabulary file of fixed size

    def run(batches):
        replay, compiled = _replay(sent.value), regex.compile(pattern)
        for doc_ids, data in byte_batches(batches, RUN_BYTES):
            split, ids, counts = encode_run(replay, compiled, data)
            of = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([[t for p in s for t in of[p]] for s in split], pa.list_(pa.int32()))],
                ["doc_id", "ids"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, ranks_file: bytes) -> DataFrame:
    """doc_id and the bytes that the ids stand for."""
    sent = encoded.sparkSession.sparkContext.broadcast(ranks_file)

    def run(batches):
        tokens = _replay(sent.value).tokens
        for batch in batches:
            back = [b"".join(map(tokens.__getitem__, ids)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(back, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_file: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text, encoded and decoded in one pass.

    Written ids and decoded bytes are made once for each distinct piece of a run.
    """
    sent = docs.sparkSession.sparkContext.broadcast(ranks_file)

    def run(batches):
        replay, compiled = _replay(sent.value), regex.compile(pattern)
        for doc_ids, data in byte_batches(batches, RUN_BYTES):
            split, ids, counts = encode_run(replay, compiled, data)
            ends = np.cumsum(counts).tolist()
            flat = ids.tolist()
            written, back, start = [], [], 0
            for end in ends:
                own = flat[start:end]
                written.append(",".join(map(str, own)))
                back.append(b"".join([replay.tokens[t] for t in own]))
                start = end
            size = counts.tolist()
            n, digest, decoded = [], [], []
            for s in split:
                n.append(sum([size[p] for p in s]))
                digest.append(hashlib.sha256(",".join([written[p] for p in s]).encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([back[p] for p in s])).hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded)],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    import public_tokenizers
    with open(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks_file = f.read()
    return round_trip_digests(table(spark, sf_dir, "documents"), ranks_file, public_tokenizers.PATTERN)
