"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from wavemill.llm.common import giving_back
from wavemill.llm.text import row_groups, utf8

PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BITS = [1 << k for k in range(256)]
#: A space that the next character does not take as its own.
_LOOSE_SPACE = re.compile(r" (?:[\s\x1c-\x1f\x85]|\Z)")
#: Characters that are pre-tokens by themselves at the end of a word.
_STOPS = frozenset(".,;:!?")
#: Bytes of text whose cuts are encoded together, and of text whose ids are laid out together.
GROUP, LAYOUT = 1 << 22, 1 << 19
#: Pieces with more bytes than this have a rank queue each, and so have pieces of which there are fewer than this.
LONG, FEW = 64, 4000
#: Cuts that are encoded together.
BLOCK = 1 << 15


class BytePairs:
    """Byte-level BPE by a table of ranks, as bytes to id. Ids are ranks; every single byte must have one.

    Pairs wait in a rank queue: a bucket of positions for each merge rank, and two levels of bitmaps with 256 ways that tell
    which buckets have entries. The next rank takes two find-first-set steps, however many ranks or positions there are, so
    a pre-token of n bytes takes about n steps. A bucket is a heap: the leftmost position comes first. Many short pieces share
    one queue (:meth:`encode_pieces`): a bucket then holds positions of all of them, which numpy merges at once.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.span = max(ranks.values()) + 1
        self.tokens = [b""] * self.span
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        self.pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    self.pairs[a * self.span + b] = rank
        self.filled = [0] * ((self.span >> 8) + 1)
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(self.pairs.values(), np.int32, len(keys))[order], np.int32(-1))

    @classmethod
    def parse(cls, content: bytes) -> BytePairs:
        """From a file of lines: the token in base64, a blank, its rank."""
        return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token})

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: merge the pair of lowest rank, leftmost first, until no pair has a rank."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not piece:
            return []
        span, rank_of, filled, bits = self.span, self.pairs.get, self.filled, _BITS
        ids = [self.bytes[b] for b in piece]
        n = len(ids)
        after, before, held = list(range(1, n + 1)), list(range(-1, n - 1)), [-1] * n
        buckets: dict[int, list[int]] = {}
        top, left = 0, ids[0]
        for k in range(n - 1):
            right = ids[k + 1]
            rank = rank_of(left * span + right)
            left = right
            if rank is not None:
                held[k] = rank
                if rank in buckets:
                    buckets[rank].append(k)  # ascending, so still a heap
                else:
                    buckets[rank] = [k]
                    filled[rank >> 8] |= bits[rank & 255]
                    top |= 1 << (rank >> 8)
        while top:
            word = (top & -top).bit_length() - 1
            ways = filled[word]
            rank = (word << 8) + (ways & -ways).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                k = heappop(bucket)
            else:
                k = bucket[0]
                del buckets[rank]
                filled[word] = ways = ways & (ways - 1)
                if not ways:
                    top &= top - 1
            if held[k] != rank:  # stale: this pair has since been merged or changed
                continue
            gone = after[k]
            end = after[gone]
            ids[k], held[k], ids[gone], held[gone], after[k] = rank, -1, -1, -1, end
            if end < n:
                before[end] = k
                merged = rank_of(rank * span + ids[end])
                if merged is not None:
                    held[k] = merged
                    if merged in buckets:
                        heappush(buckets[merged], k)
                    else:
                        buckets[merged] = [k]
                        filled[merged >> 8] |= bits[merged & 255]
                        top |= 1 << (merged >> 8)
            k = before[k]
            if k >= 0:
                merged = rank_of(ids[k] * span + rank)
                if merged is None:
                    held[k] = -1
                else:
                    held[k] = merged
                    if merged in buckets:
                        heappush(buckets[merged], k)
                    else:
                        buckets[merged] = [k]
                        filled[merged >> 8] |= bits[merged & 255]
                        top |= 1 << (merged >> 8)
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of many pre-tokens, each as little-endian 32-bit integers.

        Short ones wait in one queue. The lowest rank of all is the lowest of each piece that has it, and a piece merges its
        leftmost pair of that rank only; its other ones go back into the bucket, since a lower rank may have come up.
        """
        found, shared = [b""] * len(pieces), []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                found[k] = whole.to_bytes(4, "little")
            elif 0 < len(piece) <= LONG and len(pieces) >= FEW:
                shared.append(k)
            else:
                found[k] = np.array(self.encode_piece(piece), "<u4").tobytes()
        if shared:
            ids, bounds = self._merge([pieces[k] for k in shared])
            data, bounds = ids.tobytes(), (bounds * 4).tolist()
            for k, low, high in zip(shared, bounds[:-1], bounds[1:], strict=True):
                found[k] = data[low:high]
        return found

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, -1 where a pair has none or one is no id."""
        keys = left * np.int64(self.span) + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], -1)

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and the bounds of each. A place without an id lies before, between and after them."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.concatenate([[0], np.cumsum(sizes + 1)])
        ids = np.array(self.bytes, np.int32)[np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)]
        ids[stops] = -1
        n = len(ids)
        after, before, held = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32), np.full(n, -1, np.int32)
        owner = np.zeros(n, np.int32)
        owner[stops[1:-1] + 1] = 1
        owner = np.cumsum(owner, dtype=np.int32)
        held[:-1] = self._ranks_of(ids[:-1], ids[1:])
        buckets: dict[int, list[np.ndarray]] = {}
        filled, top = [0] * len(self.filled), 0

        def put(ranks: np.ndarray, places: np.ndarray) -> int:
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            words = 0
            for rank, low, high in zip(ranks[cuts[:-1]].tolist(), cuts[:-1], cuts[1:], strict=True):
                if rank in buckets:
                    buckets[rank].append(places[low:high])
                else:
                    buckets[rank] = [places[low:high]]
                    filled[rank >> 8] |= _BITS[rank & 255]
                    words |= 1 << (rank >> 8)
            return words

        at = np.flatnonzero(held >= 0).astype(np.int32)
        if len(at):
            top = put(held[at], at)
        while top:
            word = (top & -top).bit_length() - 1
            ways = filled[word]
            rank = (word << 8) + (ways & -ways).bit_length() - 1
            parts = buckets.pop(rank)
            filled[word] = ways = ways & (ways - 1)
            if not ways:
                top &= top - 1
            at = parts[0] if len(parts) == 1 else np.concatenate(parts)
            at = at[held[at] == rank]  # the others are stale: those pairs have since been merged or changed
            if not len(at):
                continue
            if len(at) > 1:
                at = np.sort(at)
                of = owner[at]
                again = of[1:] == of[:-1]
                if again.any():
                    buckets[rank] = [at[1:][again]]
                    filled[word] |= _BITS[rank & 255]
                    top |= 1 << word
                    at = at[np.concatenate([[True], ~again])]
            gone, prior = after[at], before[at]
            end = after[gone]
            ids[at], ids[gone], held[gone], after[at], before[end] = rank, -1, -1, end, at
            places = np.concatenate([at, prior])
            merged = np.full(len(at), rank, np.int32)
            ranks = self._ranks_of(np.concatenate([merged, ids[prior]]), np.concatenate([ids[end], merged]))
            held[places] = ranks
            some = ranks >= 0
            if some.any():
                top |= put(ranks[some], places[some])
        kept = ids >= 0
        return ids[kept].astype("<u4"), np.concatenate([[0], np.cumsum(kept)])[stops]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[x] for x in ids])


class _Memory(dict):
    """A bounded memory of computed values in two generations; keys of over 64 characters aren't kept."""

    def __init__(self, compute: Callable[[str], bytes], limit: int) -> None:
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        self.keep(key, value)
        return value

    def keep(self, key: str, value: bytes) -> None:
        if len(key) <= 64:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value

    def recall(self, key: str) -> bytes | None:
        """What is remembered, without computing it."""
        value = self.get(key)
        return self.old.get(key) if value is None else value


class TextEncoder:
    """Ids of whole texts as little-endian 32-bit integers, from a function that encodes one pre-token.

    A pre-token always ends before a space that is followed by another kind of character, so a text is cut there, and
    what each cut gave is remembered, within a bound. A cut that isn't one pre-token is put together from those it has, and
    those that begin with a space are cuts themselves. ``encode_word`` may encode a space and a word of ASCII letters, given
    without the space. ``encode_many`` may encode a list of different pre-tokens together, which columns then do with all that isn't
    remembered. Texts that hold one of ``special`` go to ``encode_special`` instead.
    """

    def __init__(self, encode_pretoken: Callable[[str], bytes], limit: int = 400_000, encode_word: Callable[[str], bytes] | None = None, special: Sequence[str] = (), encode_special: Callable[[str], bytes] | None = None, encode_many: Callable[[list[str]], list[bytes]] | None = None) -> None:
        self.split, self.encode_pretoken = regex.compile(PRETOKEN).findall, encode_pretoken
        self.encode_word = encode_word or (lambda word: encode_pretoken(" " + word))
        self.special, self.encode_special, self.encode_many = special, encode_special, encode_many
        self.cuts, self.others = _Memory(self._cut, limit), _Memory(encode_pretoken, limit // 8)

    def _cut(self, cut: str) -> bytes:
        if cut.isascii():
            if cut.isalpha():
                return self.encode_word(cut)
            if cut[-1:] in _STOPS and cut[:-1].isalpha():
                return self.cuts[cut[:-1]] + self.others[cut[-1]]
        pretokens = self.split(" " + cut)
        return self.encode_pretoken(pretokens[0]) if len(pretokens) == 1 else self._joined(pretokens)

    def _joined(self, pretokens: list[str]) -> bytes:
        return b"".join([self.cuts[p[1:]] if p[0] == " " and len(p) > 1 else self.others[p] for p in pretokens])

    def _pretokens(self, cut: str) -> list[str]:
        if cut.isascii():
            if cut.isalpha():
                return [" " + cut]
            if cut[-1:] in _STOPS and cut[:-1].isalpha():
                return [" " + cut[:-1], cut[-1]]
        return self.split(" " + cut)

    def _together(self, cuts: list[str]) -> list[bytes]:
        """What each of some different cuts gives."""
        if self.encode_many is None:
            return [self.cuts[cut] for cut in cuts]
        found, parts, each = [self.cuts.recall(cut) for cut in cuts], {}, {}
        for k, cut in enumerate(cuts):
            if found[k] is None:
                parts[k] = pretokens = self._pretokens(cut)
                for p in pretokens:
                    if p not in each:
                        each[p] = self.cuts.recall(p[1:]) if p[0] == " " and len(p) > 1 else self.others.recall(p)
        new = [p for p, value in each.items() if value is None]
        each.update(zip(new, self.encode_many(new), strict=True))
        for k, pretokens in parts.items():
            found[k] = each[pretokens[0]] if len(pretokens) == 1 else b"".join([each[p] for p in pretokens])
            self.cuts.keep(cuts[k], found[k])
        return found

    def encode(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self.encode_special(text)
        cuts = text.split(" ")
        if _LOOSE_SPACE.search(text):
            joined = [cuts[0]]
            for cut in cuts[1:]:
                if cut and not cut[0].isspace():
                    joined.append(cut)
                else:
                    joined[-1] += " " + cut
            cuts = joined
        return self._joined(self.split(cuts[0])) + b"".join(map(self.cuts.__getitem__, cuts[1:]))

    def forget(self) -> None:
        """Give up what is remembered."""
        for memory in (self.cuts, self.others):
            memory.clear()
            memory.old = {}

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same for a column, null as empty: for each group of some rows their ids as one array, and the rows' bounds in it."""
        texts = texts.fill_null("")
        for low, high in row_groups(utf8(texts)[1], GROUP):
            yield from self._encode_rows(texts.slice(low, high - low))

    def _encode_rows(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each different cut is looked up once, and numpy lays the ids out; rows with loose spaces are encoded by themselves."""
        pieces = pc.split_pattern(texts, " ")
        bounds = np.asarray(pieces.offsets).astype(np.int64)
        starts, counts = bounds[:-1] - bounds[0], np.diff(bounds)
        known = pieces.flatten().dictionary_encode()
        del pieces
        cuts, codes = known.dictionary.to_numpy(zero_copy_only=False).tolist(), np.array(known.indices, np.int32)
        del known
        loose = [not cut or cut[0].isspace() for cut in cuts]
        odd = np.array(loose, bool)[codes]
        odd[starts] = False
        alone = np.logical_or.reduceat(odd, starts)
        for x in self.special:
            alone |= np.asarray(pc.match_substring(texts, x).to_numpy(zero_copy_only=False), bool)
        heads = [cuts[k] for k in codes[starts].tolist()]
        codes[np.repeat(alone, counts)] = len(cuts) + len(starts)
        codes[starts] = len(cuts) + np.arange(len(starts))
        fine = [k for k, no in enumerate(loose) if not no]
        found = [b""] * len(cuts)
        for first in range(0, len(fine), BLOCK):
            block = fine[first : first + BLOCK]
            for k, value in zip(block, self._together([cuts[k] for k in block]), strict=True):
                found[k] = value
        del cuts, fine
        for row, whole in enumerate(alone.tolist()):
            found.append(self.encode(texts[row].as_py()) if whole else self._joined(self.split(heads[row])))
        found.append(b"")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, at = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        del found
        for low, high in row_groups(utf8(texts)[1], LAYOUT):
            own = codes[starts[low] : starts[high - 1] + counts[high - 1]]
            lengths = sizes[own]
            ends = np.cumsum(lengths)
            ids = flat[np.arange(ends[-1]) + np.repeat(at[own] - (ends - lengths), lengths)]
            yield ids, np.concatenate([[0], ends[starts[low:high] - starts[low] + counts[low:high] - 1]])


#: Cuts that a worker remembers within a task; it forgets them when the task ends, since other stages run in the same worker.
REMEMBERED = 100_000

_encoders: dict[str, tuple[BytePairs, TextEncoder, list[str]]] = {}


def _encoder(content: bytes) -> tuple[BytePairs, TextEncoder, list[str]]:
    """One per worker process and rank file."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _encoders:
        pairs = BytePairs.parse(content)
        text = TextEncoder(lambda s: array("I", pairs.encode_piece(s.encode())).tobytes(), limit=REMEMBERED, encode_many=lambda many: pairs.encode_pieces([s.encode() for s in many]))
        _encoders[key] = pairs, text, [str(x) for x in range(pairs.span)]
    return _encoders[key]


def bpe_encode(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text: id_col, ids array<int>.

    One row per input row, in no order; a null text counts as empty and gives an empty array; repeated rows repeat; a null
    id stays null; an empty table gives no rows. Other columns are left out, so their names can't clash. A text is held in one
    task with about 30 bytes for each of its tokens, however long it is; short ones are encoded some megabytes at a time. The
    rank file (about 1 MB, fixed by the tokenizer) is read on the driver and broadcast. Nothing is shuffled.
    """
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(_read(ranks_path))

    @giving_back
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, encoder, _ = _encoder(content.value)
        for batch in batches:
            row = 0
            for ids, bounds in encoder.encode_column(batch.column(1)):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.view("<i4")))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(lists)), lists], ["id", "ids"])
                row += len(lists)
        encoder.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks_path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Decode arrays of ids: id_col, data binary. Null and empty arrays give no bytes."""
    content = encoded.sparkSession.sparkContext.broadcast(_read(ranks_path))

    @giving_back
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, _, _ = _encoder(content.value)
        for batch in batches:
            out = [pairs.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "data"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(id_col, ids_col).mapInArrow(decode, f"`{id_col}` {kind}, data binary")


def bpe_digest(docs: DataFrame, ranks_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text, decode the ids, and digest both in one pass without keeping either.

    Rows as in :func:`bpe_encode`: id_col, n_tokens bigint, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of the decoded bytes), both lower-case hex.
    """
    content = docs.sparkSession.sparkContext.broadcast(_read(ranks_path))

    @giving_back
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, encoder, numerals = _encoder(content.value)
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for found, bounds in encoder.encode_column(batch.column(1)):
                for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    ids = found[low:high].tolist()
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join([numerals[x] for x in ids]).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(pairs.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], ["id", "n", "a", "b"])
        encoder.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(digest, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
