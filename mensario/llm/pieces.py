"""SentencePiece encoding and decoding by vectorised merge rounds.

The words of a batch of texts lie in one flat array of symbols. Where no piece of the
vocabulary holds two neighbours side by side, nothing can ever join them, so the array
is cut there into segments that are merged independently. Each round looks up the rank of
every neighbouring pair, takes the least of each segment, merges all its occurrences at
once from the left, closes the gaps and cuts anew; segments without a pair leave. The
result is that of merging one pair at a time, best score first, leftmost among equals.

Models with byte-pair merges, byte fallback, a dummy space in front and no further
normalisation are read; any other raises ValueError.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A space inside pieces, as the format fixes it.
SPACE = "▁"
#: Characters of texts encoded, and ids decoded, at once: some twenty arrays are as long. Distinct words a task keeps; longer ones are not kept.
BATCH_SYMBOLS, KEPT_WORDS, KEPT_LENGTH = 1 << 18, 1 << 17, 48
_NO_RANK = np.iinfo(np.int32).max
_GONE = "\ufffd"


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of all stretches, one after another."""
    ends = np.cumsum(counts)
    if not len(ends):
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) - np.repeat(ends - counts - starts, counts)


class _Lookup:
    """int64 keys to int32 values in a table of slots, for whole arrays of keys at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.values = np.zeros(self.mask + 1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.keys[slot[taken]], self.values[slot[taken]] = keys[left[taken]], values[left[taken]]
            rest = np.ones(len(left), bool)
            rest[taken] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, missing: int) -> np.ndarray:
        out = np.full(len(keys), missing, np.int32)
        at, slot = np.arange(len(keys)), self._slot(keys)
        while len(at):
            there = self.keys[slot]
            hit = there == keys[at]
            out[at[hit]] = self.values[slot[hit]]
            more = ~hit & (there >= 0)
            at, slot = at[more], (slot[more] + 1) & self.mask
        return out


class Vocabulary:
    """What encoding and decoding need of a model, in arrays whose size depends on the vocabulary alone."""

    def __init__(self, model: bytes):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as proto

        said = proto.ModelProto.FromString(model)
        plain = said.normalizer_spec
        if (said.trainer_spec.model_type != proto.TrainerSpec.BPE or not said.trainer_spec.byte_fallback or plain.precompiled_charsmap
                or plain.remove_extra_whitespaces or not plain.add_dummy_prefix or not plain.escape_whitespaces
                or said.trainer_spec.treat_whitespace_as_suffix or said.denormalizer_spec.precompiled_charsmap):
            raise ValueError("the model needs merges, byte fallback, a dummy prefix and no normalisation")
        library = spm.SentencePieceProcessor(model_proto=model)
        n = library.get_piece_size()
        self.size, self.end = n, library.eos_id()
        self.piece = [library.id_to_piece(i) for i in range(n)]
        normal = [i for i, p in enumerate(said.pieces) if p.type == p.NORMAL]
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in said.pieces):
            raise ValueError("models with user-defined or unused pieces are not read")
        self.byte = np.array([library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        symbols = {self.piece[i]: i for i in normal}
        for extra in sorted({c for i in normal for c in self.piece[i]} - symbols.keys()):
            symbols[extra] = len(symbols) + n  # a character that only occurs inside pieces
        self.width = max(symbols.values(), default=0) + 1
        scores = np.array([p.score for p in said.pieces], np.float32)
        order = -np.unique(-scores[normal])
        rank = np.full(self.width, _NO_RANK, np.int32)
        rank[normal] = np.searchsorted(-order, -scores[normal])
        merges, beside = {}, set()
        for i in normal:
            text = self.piece[i]
            for middle in range(1, len(text)):
                for start in range(middle):
                    left = symbols.get(text[start:middle])
                    if left is None:
                        continue
                    for end in range(middle + 1, len(text) + 1):
                        right = symbols.get(text[middle:end])
                        if right is not None:
                            beside.add(left * self.width + right)
                            if end - start == len(text):
                                merges[left * self.width + right] = i
        keys = np.array(list(merges), np.int64).reshape(-1)
        made = np.array(list(merges.values()), np.int32).reshape(-1)
        # Pieces of equal score, and pieces whose making opens a pair that is due before its other occurrences: one at a time.
        shared = np.bincount(rank[normal], minlength=1)
        self.careful = np.zeros(self.width, bool)
        self.careful[normal] = shared[rank[normal]] > 1
        for side in (keys // self.width, keys % self.width):
            self.careful[side[rank[made] <= rank[side]]] = True
        both = np.array(sorted(beside), np.int64)
        value = np.full(len(both), -1, np.int32)  # side by side inside a piece, but not a merge
        value[np.searchsorted(both, keys)] = made
        self.rank, self._pairs = rank, (both, value)
        chars = [(ord(t), s) for t, s in symbols.items() if len(t) == 1]
        self._chars = np.array(chars, np.int64).reshape(-1, 2)
        #: Whether a space only ever begins a word: no piece has one behind another character.
        self.words_apart = not any(SPACE in t.lstrip(SPACE) for t in symbols)
        self._inside = frozenset(c for i in normal for c in self.piece[i][1:])
        unknown = said.trainer_spec.unk_surface.encode()
        kinds = [p.type for p in said.pieces]
        types = proto.ModelProto.SentencePiece
        surface = [
            b"" if k == types.CONTROL else unknown if k == types.UNKNOWN else bytes([int(p[3:5], 16)]) if k == types.BYTE else p.replace(SPACE, " ").encode()
            for p, k in zip(self.piece, kinds)
        ]
        self.lengths = np.array([len(s) for s in surface], np.int64)
        self._surface = np.frombuffer(b"".join(surface), np.uint8)
        self._begins = np.cumsum(self.lengths) - self.lengths
        self.is_byte = np.array([k == types.BYTE for k in kinds])
        self.is_text = np.array([k == types.NORMAL for k in kinds])
        self._opens = np.array([k == types.NORMAL and p.startswith(SPACE) for p, k in zip(self.piece, kinds)])
        self._ready = False

    def _prepare(self) -> None:
        """Tables that are larger than what they are built from, so they are not shipped."""
        if not self._ready:
            self._table = _Lookup(*self._pairs)
            self._symbol = np.full(0x110000, -1, np.int32)
            self._symbol[self._chars[:, 0]] = self._chars[:, 1]
            self._ready = True

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_table", "_symbol")} | {"_ready": False}

    def never_follows(self, char: str) -> bool:
        """Whether no piece holds ``char`` anywhere but at its beginning."""
        return char not in self._inside

    def _pair(self, symbols: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """For each place the piece it makes with the next one: -1 none although a piece holds both, -2 cut for good."""
        pair = np.full(len(symbols), -2, np.int32)
        at = np.flatnonzero(~cut[1:] & (symbols[:-1] >= 0) & (symbols[1:] >= 0))
        pair[at] = self._table.find(symbols[at].astype(np.int64) * self.width + symbols[at + 1], -2)
        return pair

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``words`` in one array, and the number of each word's. Spaces are SPACE already; nothing is put in front."""
        self._prepare()
        code = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(sizes) - sizes
        final = np.full(len(code), -2, np.int32)  # the symbol that begins at a character, -2 where none does
        symbols, place = self._symbol[code], np.arange(len(code))
        cut = np.zeros(len(code) + 1, bool)
        cut[starts] = True
        cut = cut[:-1]
        while len(symbols):
            pair = self._pair(symbols, cut)
            cut = np.r_[True, pair[:-1] == -2]
            first = np.flatnonzero(cut)
            counts = np.diff(np.r_[first, len(symbols)])
            rank = np.where(pair >= 0, self.rank[pair], _NO_RANK)
            least = np.minimum.reduceat(rank, first)
            best = np.repeat(least, counts)
            over = best == _NO_RANK
            final[place[over]] = symbols[over]
            chosen = (rank == best) & ~over
            at = np.arange(len(symbols))
            slow = chosen & self.careful[np.maximum(pair, 0)]
            if slow.any():  # only the leftmost of these segments
                segment = np.repeat(np.arange(len(first)), counts)
                held = np.zeros(len(first), bool)
                held[segment[slow]] = True
                mine = np.flatnonzero(chosen & held[segment])
                _, leftmost = np.unique(segment[mine], return_index=True)
                chosen[mine] = False
                chosen[mine[leftmost]] = True
            begins = chosen & ~np.r_[False, chosen[:-1]]
            chosen &= ((at - np.maximum.accumulate(np.where(begins, at, 0))) & 1) == 0
            symbols = np.where(chosen, pair, symbols)
            keep = ~over
            keep[1:] &= ~chosen[:-1]
            symbols, place, cut = symbols[keep], place[keep], cut[keep]
        held = np.flatnonzero(final != -2)
        ids, letters = final[held], code[held]
        bare = (ids < 0) | (ids >= self.size)
        many = np.where(bare, 1 + (letters > 0x7F) + (letters > 0x7FF) + (letters > 0xFFFF), 1)
        out = np.repeat(ids, many)
        if bare.any():
            raw = np.frombuffer("".join(map(chr, letters[bare].tolist())).encode("utf-8", "surrogatepass"), np.uint8)
            out[np.repeat(bare, many)] = self.byte[raw]
        before = np.r_[0, np.cumsum(many)][np.searchsorted(held, np.r_[starts, len(code)])]
        return out, np.diff(before)

    def split(self, text: str) -> list[str]:
        """Words of a text as the merges see it: a space in front, spaces as SPACE, each word with those before it."""
        text = SPACE + text.replace(" ", SPACE) if text else ""
        return _WORDS.findall(text) if self.words_apart else [text] if text else []

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of ``ids``, ``counts`` ids each. Bytes that are no character become U+FFFD each."""
        n_bytes = self.lengths[ids]
        raw = self._surface[ragged(self._begins[ids], n_bytes)].tobytes()
        ends = np.cumsum(counts)
        edges = np.r_[0, np.cumsum(n_bytes)][np.r_[0, ends]]
        out = []
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            mine = ids[ends[k] - counts[k] : ends[k]]
            opening = np.flatnonzero(n_bytes[ends[k] - counts[k] : ends[k]])[:1]
            a += int(len(opening) and self._opens[mine[opening[0]]])
            if (n_bytes[ends[k] - counts[k] : max(0, ends[k] - 1)] == 0).any():  # a control id inside ends a run of bytes
                out.append(self._mended(mine, raw[a:b]))
                continue
            try:
                out.append(raw[a:b].decode())
            except UnicodeDecodeError:
                out.append(self._mended(mine, raw[a:b]))
        return out

    def _mended(self, ids: np.ndarray, raw: bytes) -> str:
        """Runs of byte pieces decoded by themselves, other pieces as they are."""
        out, at, sizes = [], len(raw), self.lengths[ids]
        edge = np.flatnonzero(np.diff(self.is_byte[ids].astype(np.int8))) + 1
        for part in reversed(np.split(np.arange(len(ids)), edge)):
            begin = max(0, at - int(sizes[part].sum()))
            out.append(_each_bad_byte(raw[begin:at]))
            at = begin
        return "".join(reversed(out))


_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _each_bad_byte(raw: bytes) -> str:
    codecs.register_error("each_bad_byte", lambda error: (_GONE, error.start + 1))
    return raw.decode(errors="each_bad_byte")


@lru_cache(maxsize=4)
def _read(path: str) -> Vocabulary:
    with open(path, "rb") as file:
        return Vocabulary(file.read())


def vocabulary(path: str) -> Vocabulary:
    """The model at ``path``, which only the driver reads."""
    return _read(path)


class Encoder:
    """Ids of texts, words met before taken from a bounded store."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.vocabulary.split(t) for t in texts]
        known = self.known
        fresh = list({w for words in split for w in words if w not in known})
        ids, counts = self.vocabulary.encode_words(fresh)
        raw, ends = ids.astype(np.int32).tobytes(), np.cumsum(counts * 4).tolist()
        known.update(zip(fresh, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends))))
        out = [np.frombuffer(b"".join(map(known.__getitem__, words)), np.int32) for words in split]
        if len(known) > KEPT_WORDS:
            known.clear()
        else:
            for word in fresh:
                if len(word) > KEPT_LENGTH:
                    del known[word]
        return out


def by_size(batch: pa.RecordBatch, text_at: int, most: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """``batch`` in pieces of about ``most`` characters of text, with the texts; NULL is empty."""
    start, texts, size = 0, [], 0
    for i, value in enumerate(batch.column(text_at)):
        text = value.as_py() or ""
        if texts and size + len(text) > most:
            yield batch.slice(start, len(texts)), texts
            start, texts, size = i, [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield batch.slice(start, len(texts)), texts


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``: the ids of the whole text and an end id; a NULL or empty text has the end id alone.

    Repeated rows stay; no rows give no rows; columns besides doc_id and text are not looked at.
    """
    model, kind = vocabulary(path), docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder(model), np.array([model.end], np.int32)
        for batch in batches:
            for part, texts in by_size(batch, 1, BATCH_SYMBOLS):
                ids = [np.concatenate([found, end]) for found in encoder.encode(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(ids)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def _by_ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about BATCH_SYMBOLS ids."""
    counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(batch.column(1)), 0)).astype(np.int64)
    slices = (np.cumsum(counts) - counts) // BATCH_SYMBOLS
    for start in np.unique(slices, return_index=True)[1].tolist():
        yield batch.slice(start, int((slices == slices[start]).sum()))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of every row of ``encoded`` (doc_id, ids): control ids give nothing, the space in front goes.

    NULL ids are none. An id outside the vocabulary fails the job.
    """
    model, kind = vocabulary(path), encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_ids(whole):
                lists = batch.column(1)
                counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype(np.int64)
                ids = np.asarray(lists.flatten())
                if len(ids) and not (ids.min() >= 0 and ids.max() < model.size):
                    raise ValueError("an id outside the vocabulary")
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(model.decode(ids, counts), pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")
