"""SentencePiece BPE encoding and decoding by backtracking.

A token sequence is the BPE encoding of a text exactly if every token re-merges to itself and every two adjacent
tokens, merged anew from their characters, stay these two tokens. So the encoder takes the longest vocabulary match
at each position (all matches come from one Aho-Corasick pass), checks it against the token before, tries shorter
ones, and steps back where none fits; a bitfield marks positions from which no continuation exists.

Texts are cut where no piece of the vocabulary holds the two characters at the cut side by side; no merge can cross
such a place. For usual models these are the places before a space mark that follows another character.

Each worker remembers words' ids and pairs' checks in two caches of ``CACHE_BYTES`` and ``PAIR_ENTRIES`` at most, also
within one text, and empties them at the end of each task.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import map_arrow, slices

MARK = "▁"
CACHED_CHARS = 48
CACHE_BYTES = 60_000_000
ENTRY_BYTES = 240  # an entry's objects and its place in the table; its characters and ids come on top
PAIR_ENTRIES = 250_000
KEYS_AT_ONCE = 4096


class MergeCoder:
    """Encoder and decoder of one SentencePiece model of BPE type with byte fallback and identity normalisation."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm, trainer = spec.normalizer_spec, spec.trainer_spec
        if trainer.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or trainer.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("only BPE models with identity normalisation are supported")
        kind = proto.ModelProto.SentencePiece
        self.dummy = norm.add_dummy_prefix
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_id = [-1] * 256
        self.surface: list[bytes] = []
        self.bos, self.eos, self.unk = trainer.bos_id, trainer.eos_id, trainer.unk_id
        for i, p in enumerate(spec.pieces):
            if p.type == kind.NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
                self.surface.append(p.piece.replace(MARK, " ").encode())
            elif p.type == kind.BYTE:
                value = int(p.piece[1:-1], 16)
                self.byte_id[value] = i
                self.surface.append(bytes([value]))
            elif p.type == kind.CONTROL:
                self.surface.append(b"")
            elif p.type == kind.UNKNOWN:
                self.surface.append(trainer.unk_surface.encode())
            else:
                raise ValueError(f"pieces of type {p.type} are not supported")
        self.joined = {p[k : k + 2] for p in self.score for k in range(len(p) - 1)}
        self.search = ahocorasick.Automaton()
        self.stable = {p for p in self.score if self.remerge(p) == [p]}  # others never come out of merging
        for p in self.stable:
            if len(p) > 1:
                self.search.add_word(p, p)
        self.search.make_automaton()
        self.packed = {p: np.array([i], "<u4").tobytes() for p, i in self.id.items()}
        self.plain = not any(b[1] == MARK and b[0] != MARK for b in self.joined) and not any("\n" in p for p in self.score)
        self.forget()

    def forget(self) -> None:
        """Empty the caches."""
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.size = 0

    def remerge(self, text: str) -> list[str]:
        """Merge the characters of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = self.score.get(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def adjacent(self, left: str, right: str) -> bool:
        """Whether two tokens side by side stay as they are when their characters are merged anew."""
        if left[-1] + right[0] not in self.joined:
            return True
        if len(self.fits) >= PAIR_ENTRIES:
            self.fits.clear()
        ok = self.fits[left, right] = self.remerge(left + right) == [left, right]
        return ok

    def backtrack(self, chunk: str) -> list[str]:
        """The one sequence of mutually compatible tokens that spells ``chunk``."""
        n, fits, adjacent = len(chunk), self.fits, self.adjacent
        options = [[c] for c in chunk]  # tokens that start at each position, shortest first; each is tried once
        for end, piece in self.search.iter(chunk):
            options[end - len(piece) + 1].append(piece)
        failed = 0  # a bit for each position
        tokens: list[str] = []
        at, last = 0, None
        while at < n:
            untried = options[at]
            while untried:
                token = untried.pop()
                end = at + len(token)
                if failed and failed >> end & 1:
                    continue
                if last is None or (ok := fits.get((last, token))) or ok is None and adjacent(last, token):
                    tokens.append(token)
                    at, last = end, token
                    break
            else:
                failed |= 1 << at
                at -= len(tokens.pop())
                last = tokens[-1] if tokens else None
        return tokens

    def marked_ids(self, marked: str) -> bytes:
        """Packed ids of a marked text; a character that is no piece becomes the ids of its bytes."""
        packed = self.packed
        return b"".join([packed.get(t) or self.spelled(t) for t in self.backtrack(marked)])

    def spelled(self, char: str) -> bytes:
        return np.array([self.byte_id[b] if self.byte_id[b] >= 0 else self.unk for b in char.encode()], "<u4").tobytes()

    def word_ids(self, key: str) -> bytes:
        """Packed ids of a key, which stands for a mark and itself, or for itself if it starts with a line end."""
        marked = key if key[:1] == "\n" else MARK + key
        got = self.packed.get(marked) if marked in self.stable else None
        if got is None and len(key) > 1 and marked[-2:] not in self.joined:
            stem = self.known.get(key[:-1])  # "word," is "word" and ","
            if stem is None:
                stem = self.word_ids(key[:-1])
                self.remember(key[:-1], stem)
            return stem + self.marked_ids(key[-1])
        return self.marked_ids(marked) if got is None else got

    def remember(self, key: str, ids: bytes) -> None:
        if self.size > CACHE_BYTES:
            self.known.clear()
            self.size = 0
        self.known[key] = ids
        self.size += ENTRY_BYTES + len(key) + len(ids)

    def encode(self, text: str) -> bytes:
        """Ids without begin and end, packed as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        text = text.replace(MARK, " ")
        spaced = f" {text}" if self.dummy else text
        if not self.plain or not self.dummy or "  " in spaced or " \n" in spaced:
            keys = re.findall(r" +[^ ]*|[^ ]+", spaced) if self.plain else [spaced]
            return b"".join(self.marked_ids(k.replace(" ", MARK)) for k in keys)
        keys = spaced[1:].replace("\n", " \n").split(" ")  # a key that starts with a line end has no mark before it
        if text[0] == "\n":  # here the mark stands alone
            return self.marked_ids(MARK) + self._looked_up(keys[1:])
        return self._looked_up(keys)

    def _looked_up(self, keys: list[str]) -> bytes:
        if len(keys) > KEYS_AT_ONCE:
            return b"".join([self._looked_up(keys[k : k + KEYS_AT_ONCE]) for k in range(0, len(keys), KEYS_AT_ONCE)])
        known = self.known
        try:
            return b"".join([known[k] for k in keys])
        except KeyError:
            pass
        out = []
        for k in keys:
            got = known.get(k)
            if got is None:
                if len(k) <= CACHED_CHARS:
                    got = self.word_ids(k)
                    self.remember(k, got)
                else:
                    got = self.marked_ids(k if k[:1] == "\n" else MARK + k)
            out.append(got)
        return b"".join(out)

    def framed(self, text: str | None) -> bytes:
        """Packed ids with begin and end; a null text counts as empty."""
        return np.array([self.bos], "<u4").tobytes() + self.encode(text or "") + np.array([self.eos], "<u4").tobytes()

    def decode(self, packed: bytes) -> str:
        surface = self.surface
        raw = b"".join([surface[i] for i in np.frombuffer(packed, "<u4").tolist()])
        if self.dummy and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def coder(model: bytes) -> MergeCoder:
    """One coder for each Python worker, kept across tasks."""
    return MergeCoder(model)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) for each row: ``ids`` holds the whole text's ids with begin and end, packed as
    little-endian uint32, and ``decoded`` what they decode to.

    A null text counts as empty (ids: begin, end). Repeated rows and repeated or null ids give a row each; an empty
    table gives no rows; other columns are dropped. No shuffle; each task holds one Arrow batch and a bounded cache.
    """

    def run(batches):
        c = coder(model)
        try:
            for b in batches:
                for part, texts in slices(b, b.column(1)):
                    ids = [c.framed(t) for t in texts]
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array([c.decode(x) for x in ids], pa.string())], ["id", "ids", "decoded"])
        finally:
            c.forget()

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), run, f"id {kind}, ids binary, decoded string")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """(id, ids, decoded) from the output of ``encode`` or any table with ``id`` and packed ``ids`` (null: null)."""

    def run(batches):
        c = coder(model)
        for b in batches:
            for part, ids in slices(b, b.column(1)):
                text = pa.array([None if x is None else c.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], ["id", "ids", "decoded"])

    kind = encoded.schema["id"].dataType.simpleString()
    return map_arrow(encoded.select("id", "ids"), run, f"id {kind}, ids binary, decoded string")


def digest(docs: DataFrame, model: bytes) -> DataFrame:
    """n_tokens and digests of ids and of the decoded text for each document."""
    done = encode(docs, model)
    return done.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
