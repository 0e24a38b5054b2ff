"""Operator 3, SentencePiece encoding and decoding on the Tokenizers library.

The model file is read as what it is, a protobuf: pieces with scores and
types, the trainer's settings, the normaliser's settings.  From these a
tokenizer of the Tokenizers library is rebuilt: normaliser, space marker,
unigram scores or merges by score, byte fallback.  Batches of words are
encoded by its threads, every different word of a batch once, and the ids are
compared with those of the SentencePiece library.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from matchday.llm.common import document_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "\u2581"
# values of the model format: piece types and model types
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: words whose ids a task remembers, and how many ids they have on average at most
REMEMBER, IDS_A_WORD = 300_000, 8
#: words that are encoded as one text, where their ids can be told apart
JOINED = 64
#: characters of the texts that are encoded at once, one text at least
GROUP = 1 << 19


# --------------------------------------------------------------- the model file


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protobuf message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at += 1
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        wire = key & 7
        if wire == 0:
            value, at = varint(at)
        elif wire == 1:
            value, at = data[at : at + 8], at + 8
        elif wire == 5:
            value, at = data[at : at + 4], at + 4
        elif wire == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {wire} in a model file")
        yield key >> 3, value


@dataclass
class PieceModel:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> "PieceModel":
        m = cls()
        for number, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, NORMAL
                for n, v in _fields(value):
                    if n == 1:
                        piece = v.decode()
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                m.pieces.append((piece, score, kind))
            elif number == 2:
                for n, v in _fields(value):
                    if n == 3:
                        m.kind = v
                    elif n == 35:
                        m.byte_fallback = bool(v)
            elif number == 3:
                for n, v in _fields(value):
                    if n == 2:
                        m.charsmap = v
                    elif n == 3:
                        m.dummy_prefix = bool(v)
                    elif n == 4:
                        m.squeeze_spaces = bool(v)
                    elif n == 5:
                        m.escape_spaces = bool(v)
        return m


# --------------------------------------------------------------- the tokenizer


def _merges(vocab: dict[str, int], scores: dict[str, float]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, the best scored result first."""
    out = []
    for piece, score in scores.items():
        pairs = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in scores and piece[i:] in scores]
        out += [(-score, vocab[a], vocab[b], a, b) for a, b in pairs]
    out.sort()
    return [(a, b) for *_, a, b in out]


def build_tokenizer(model: PieceModel):
    """The Tokenizers-library twin for text whose spaces are marks already
    (the operator adds the marks, see :meth:`Codec.normalise`)."""
    from tokenizers import Tokenizer, decoders, models, normalizers

    vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    unknown = next((p for p, _, t in model.pieces if t == UNKNOWN), None)
    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], vocab.get(unknown), model.byte_fallback)
    elif model.kind == BPE:
        usable = {p: s for p, s, t in model.pieces if t in (NORMAL, USER)}
        core = models.BPE(
            vocab=vocab, merges=_merges(vocab, usable), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback
        )
    else:
        raise ValueError("only unigram and BPE models")
    tok = Tokenizer(core)
    if model.charsmap:
        tok.normalizer = normalizers.Precompiled(model.charsmap)
    tok.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()] if model.byte_fallback else [decoders.Fuse()])
    return tok


def _splits_at_marks(model: PieceModel) -> bool:
    """Whether no piece has a mark behind another character: then the words
    of a text can be encoded one by one."""
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, t in model.pieces if t in (NORMAL, USER))


_MARK = MARK.encode()


class Codec:
    """Encodes and decodes batches of texts by one model file's bytes."""

    def __init__(self, data: bytes, threads: int = 1, verify: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = PieceModel.parse(data)
        self.tok = build_tokenizer(self.model)
        self.by_word = _splits_at_marks(self.model)
        # the ids of joined words begin at pieces with a mark: merges only, nothing is normalised again
        self.joins = self.by_word and self.model.kind == BPE and self.tok.normalizer is None
        self.opens = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces], bool)
        self._forget()
        self.bytes, self.byte_start = _surfaces(self.model)
        self.own = None
        if verify:
            import sentencepiece

            self.own = sentencepiece.SentencePieceProcessor(model_proto=data)

    def _forget(self) -> None:
        self.place: dict[str, int] = {}  # of a word among those known
        self.ids = np.zeros(0, np.int32)  # of all known words, one after the other
        self.start = np.zeros(1, np.int64)
        self.agreed = np.zeros(0, bool)  # whether both libraries give the word the same ids
        self.uses = np.zeros(0, np.int64)

    def _forget_rare(self) -> None:
        """Keeps the words used more than once, the most used up to half of
        what a task remembers; their uses count half from now on."""
        keep = np.argsort(-self.uses, kind="stable")[: min(np.count_nonzero(self.uses > 1), REMEMBER // 2)]
        keep = np.sort(keep[np.cumsum(np.diff(self.start)[keep]) <= REMEMBER // 2 * IDS_A_WORD])
        words = list(self.place)
        ids, size = _gather(self.ids, self.start, keep)
        self.place = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.ids, self.start = ids, np.concatenate([[0], np.cumsum(size)])
        self.agreed, self.uses = self.agreed[keep], self.uses[keep] // 2

    def normalise(self, text: str) -> str:
        """The text as the model's settings ask, with marks for spaces."""
        if self.tok.normalizer is not None:
            text = self.tok.normalizer.normalize_str(text)
        if self.model.squeeze_spaces:
            text = re.sub(" +", " ", text).strip(" ")
        return self.normalise_spaces(text)

    def normalise_spaces(self, text: str) -> str:
        if text and self.model.dummy_prefix:
            text = " " + text
        return text.replace(" ", MARK) if self.model.escape_spaces else text

    def _words(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The different words of all texts, the place among them of each
        word, text after text, and how many words each text has.  A word
        begins with its text or with a run of marks; where words cannot be
        encoded one by one, a text is one word."""
        marked = [self.normalise(t).encode() for t in texts]
        raw = b"".join(marked)
        border = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        begins = np.zeros(len(raw) + 1, bool)
        begins[border] = True
        if self.by_word:
            at = _marks(np.frombuffer(raw, np.uint8))
            begins[at[np.diff(at, prepend=-len(_MARK)) != len(_MARK)]] = True  # the first of a run of marks
        begins[-1] = True
        start = np.flatnonzero(begins)
        buffers = [None, pa.py_buffer(start), pa.py_buffer(raw)]
        words = pa.Array.from_buffers(pa.large_string(), len(start) - 1, buffers).dictionary_encode()
        return words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy(), np.diff(np.searchsorted(start, border))

    def _learn(self, words: Collection[str]) -> np.ndarray:
        """The places of different words, which are known from now on."""
        if len(self.place) > REMEMBER or len(self.ids) > REMEMBER * IDS_A_WORD:
            self._forget_rare()
        place = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(place < 0)
        new = list(compress(words, (place < 0).tolist()))
        # one mark, in front of something
        join = np.array([self.joins and w.rfind(MARK) == 0 < len(w) - 1 for w in new], bool)
        plain, others = list(compress(new, join.tolist())), list(compress(new, (~join).tolist()))
        new = plain + others
        place[np.concatenate([unknown[join], unknown[~join]])] = np.arange(len(self.place), len(self.place) + len(new))
        ids, sizes, agreed = [self.ids], [], [self.agreed]
        groups = [(some[k : k + 5_000], some is plain) for some in (plain, others) for k in range(0, len(some), 5_000)]
        for part, join in groups:
            flat, size = self._encode_words(part, join)
            ids.append(flat)
            sizes.append(size)
            agreed.append(self._same(part, flat, size))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new)), strict=True))
            self.ids = np.concatenate(ids)
            self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])
            self.agreed = np.concatenate(agreed)
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        return place

    def _encode_words(self, words: list[str], join: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has.  Words with one mark,
        in front, are encoded some at a time: no piece reaches over a mark, so
        each of them begins where a piece with a mark does."""
        if join:
            texts = ["".join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
            flat, _ = _flat([e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)])
            begin = np.flatnonzero(self.opens[flat])
            if len(begin) == len(words):
                return flat, np.diff(begin, append=len(flat))
        return _flat([e.ids for e in self.tok.encode_batch_fast(words, add_special_tokens=False)])

    def _same(self, words: list[str], flat: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Per word, whether the SentencePiece library has the same ids; words
        as it takes them (a mark alone it never gets to see: an empty text has
        no pieces)."""
        m = self.model
        if self.own is None:
            return np.ones(len(words), bool)
        plain = words
        if m.dummy_prefix:
            space = MARK if m.escape_spaces else " "
            plain = [w[1:] if w[0] == space else w for w in words]
        if m.escape_spaces:
            plain = [w.replace(MARK, " ") if MARK in w else w for w in plain]
        theirs, count = _flat(self.own.encode(plain, num_threads=1))
        out = count == size
        if out.all() and np.array_equal(theirs, flat):
            return out
        mine, other = np.cumsum(size) - size, np.cumsum(count) - count
        for i in np.flatnonzero(out).tolist():
            out[i] = np.array_equal(flat[mine[i] : mine[i] + size[i]], theirs[other[i] : other[i] + count[i]])
        if m.dummy_prefix:  # not at the beginning of a text, or a mark alone: nothing to compare with
            out |= np.array([not w.startswith(MARK) or w == MARK for w in words], bool)
        return out

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool], list[bool]]:
        """Per text its ids, whether both libraries agree on all its words,
        and whether its ids, decoded, give the text back."""
        different, which, counts = self._words(texts)
        place = self._learn(different)
        self.uses[place] += np.bincount(which, minlength=len(place))
        words = place[which]
        flat, size = _gather(self.ids, self.start, words)
        upto = np.concatenate([[0], np.cumsum(size)])
        border = np.concatenate([[0], np.cumsum(counts)])
        ends = upto[border]
        ids = [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        missed = np.concatenate([[0], np.cumsum(~self.agreed[words])])[border]
        back = self._decoded(flat, ends)
        whole = [t.encode("utf-8", "surrogatepass") == b for t, b in zip(texts, back, strict=True)]
        return ids, (np.diff(missed) == 0).tolist(), whole

    def _decoded(self, flat: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """Per text the bytes of its pieces one after the other, without the
        space that encoding put in front."""
        raw, size = _gather(self.bytes, self.byte_start, flat)
        at = np.concatenate([[0], np.cumsum(size)])[ends].tolist()
        raw = raw.tobytes()
        out = [raw[a:b] for a, b in zip(at, at[1:], strict=False)]
        return [x[1:] if x.startswith(b" ") else x for x in out] if self.model.dummy_prefix else out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Per row of ids the text: pieces joined, bytes put together, marks
        turned to spaces, the space that encoding put in front removed."""
        out = []
        for text in self.tok.decode_batch([x.tolist() for x in ids], skip_special_tokens=False):
            text = text.replace(MARK, " ") if self.model.escape_spaces else text
            out.append(text[1:] if self.model.dummy_prefix and text.startswith(" ") else text)
        return out


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and how many each list has."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum())), size


def _marks(raw: np.ndarray) -> np.ndarray:
    """Where the marks begin in the bytes of a text."""
    at = np.flatnonzero(raw[: max(len(raw) - 2, 0)] == _MARK[0])
    return at[(raw[at + 1] == _MARK[1]) & (raw[at + 2] == _MARK[2])]


def _gather(values: np.ndarray, start: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs values[start[i]:start[i + 1]] of ``which``, one after the other, and their sizes."""
    begin = start[which]
    size = start[which + 1] - begin
    return values[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))], size


def _surfaces(model: PieceModel) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, borders): what each piece decodes to."""
    out = []
    for piece, _, kind in model.pieces:
        if kind == BYTE:
            out.append(bytes([int(piece[3:5], 16)]))
        elif kind == UNKNOWN:
            out.append(" \u2047 ".encode())
        elif kind == CONTROL:
            out.append(b"")
        else:
            out.append((piece.replace(MARK, " ") if model.escape_spaces else piece).encode())
    return np.frombuffer(b"".join(out), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int64)


# --------------------------------------------------------------- Spark


def _encode(data, threads: int, verify: bool, with_ids: bool):
    def run(batches):
        codec = Codec(data.value, threads, verify)
        byte_ids = [i for i, (_, _, t) in enumerate(codec.model.pieces) if t == BYTE]
        unknown = next((i for i, (_, _, t) in enumerate(codec.model.pieces) if t == UNKNOWN), -1)
        is_byte = np.zeros(len(codec.model.pieces) + 1, bool)
        is_byte[byte_ids] = True
        for batch in batches:
            texts = batch.column("text").to_pylist()
            start = 0
            while start < len(texts):
                size, end = 0, start
                while end < len(texts) and (end == start or size < GROUP):
                    size += len(texts[end] or "")
                    end += 1
                part = texts[start:end]
                ids, agreed, whole = codec.encode([t or "" for t in part])
                digests = [hashlib.sha256(x.astype("<i4").tobytes()).hexdigest() for x in ids]
                cols = [
                    batch.column("doc_id").slice(start, end - start).cast(pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([int(is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([int((x == unknown).sum()) for x in ids], pa.int64()),
                    pa.array(digests),
                    pa.array(whole),
                    pa.array(agreed),
                ]
                if with_ids:
                    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(cols, names=[*_NAMES, *(["ids"] if with_ids else [])])
                start = end
            pa.default_memory_pool().release_unused()

    return run


_COLUMNS = "doc_id long, n_tokens long, n_bytes long, n_unknown long, ids_sha256 string, round_trip boolean, parity boolean"
_NAMES = [c.split()[0] for c in _COLUMNS.split(", ")]


def encode_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_path: str = MODEL, threads: int = 2,
    verify: bool = True, with_ids: bool = True,
) -> DataFrame:
    """Per row doc_id, n_tokens, n_bytes (byte-fallback tokens), n_unknown,
    ids_sha256 (of the ids as little-endian 32-bit integers), round_trip
    (the document's ids were decoded and gave its text back), parity (the
    SentencePiece library gives all its words, each by itself, the same ids;
    where not, the ids are still the rebuilt tokenizer's) and, if asked, ids.

    Null and empty texts have no ids and come back as empty texts.  Null ids
    of documents pass through, repeated rows are encoded each, an empty table
    gives no rows; further columns are not looked at.  The model file is read
    on the driver and sent to the tasks.
    """
    with open(model_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = _COLUMNS + (", ids array<int>" if with_ids else "")
    return document_columns(docs, id_col, text_col).mapInArrow(_encode(data, threads, verify, with_ids), schema)
