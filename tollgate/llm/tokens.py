"""Token ids of whole texts: a task keeps the ids of chunks it has met, within a bound."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from tollgate.llm.words import BYTE_CODES, run_hashes

OTHER, SPACE, LETTER, MARK = range(4)
#: Bytes that the chunks kept by an encoder may take, about, before it starts anew.
KEPT_BYTES = 64_000_000
#: What a kept chunk takes beside its bytes, and what each of its ids takes.
ENTRY_BYTES, ID_BYTES = 29, 4


def byte_classes() -> np.ndarray:
    """Classes of single bytes: ASCII white space, letters, and marks without the apostrophe."""
    classes = np.full(256, OTHER, np.uint8)
    classes[[9, 10, 11, 12, 13, 32]] = SPACE
    for byte in range(33, 127):
        if chr(byte).isalpha():
            classes[byte] = LETTER
        elif not chr(byte).isdigit() and chr(byte) != "'":
            classes[byte] = MARK
    return classes


@lru_cache(maxsize=1)
def byte_letters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary, as a table for translate.

    Printable Latin-1 stands for itself; all other bytes take the characters from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    names = {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}
    return names


class Chunks:
    """Ids of chunks by number, in arrays: chunks are found by 64-bit hash and compared byte by byte.

    At the bound those stay that were met again, and the others are dropped; all, if that leaves too many.
    A chunk keeps its number till then.
    """

    def __init__(self, kept_bytes: int = KEPT_BYTES):
        self.kept_bytes = kept_bytes
        self.clear()

    def clear(self) -> None:
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted, and their numbers
        self.text, self.borders = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.id_borders = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.met = np.zeros(0, bool)

    def taken(self) -> int:
        return len(self.text) + ENTRY_BYTES * len(self.met) + ID_BYTES * len(self.ids)

    def thin(self) -> None:
        """Drop what was not met again."""
        kept = np.flatnonzero(self.met)
        stay = self.met[self.order]
        self.hashes, self.order = self.hashes[stay], (np.cumsum(self.met, dtype=np.int32) - 1)[self.order[stay]]
        self.text, self.borders = picked(self.text, self.borders, kept)
        self.ids, self.id_borders = picked(self.ids, self.id_borders, kept)
        self.met = np.zeros(len(kept), bool)

    def numbers(self, data: np.ndarray, borders: np.ndarray, ids_of) -> np.ndarray:
        """The distinct chunks' numbers; ids_of gives the ids of those that are new, as many as they may be."""
        if self.taken() > self.kept_bytes:
            self.thin()
            if self.taken() > self.kept_bytes // 2:
                self.clear()
        hashes = run_hashes(BYTE_CODES[data], borders[:-1], borders[1:])
        found = self.known(data, borders, hashes)
        self.met[found[found >= 0]] = True
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            raw = data.tobytes()
            starts, ends = borders[unknown].tolist(), borders[unknown + 1].tolist()
            ids = ids_of([raw[a:b] for a, b in zip(starts, ends, strict=True)])
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            text, places = picked(data, borders, unknown)
            found[unknown] = len(self.met) + np.arange(len(unknown))
            by_hash = np.argsort(hashes[unknown])
            new = hashes[unknown][by_hash]
            at = np.searchsorted(self.hashes, new)
            self.hashes = np.insert(self.hashes, at, new)
            self.order = np.insert(self.order, at, found[unknown][by_hash])
            self.borders = np.concatenate([self.borders, len(self.text) + places[1:]])
            self.text = np.concatenate([self.text, text])
            self.id_borders = np.concatenate([self.id_borders, len(self.ids) + np.cumsum(lengths)])
            self.ids = np.concatenate([self.ids, flat])
            self.met = np.concatenate([self.met, np.zeros(len(unknown), bool)])
        return found

    def known(self, data: np.ndarray, borders: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each chunk that is kept, else -1; one hidden behind an equal hash counts as new."""
        found = np.full(len(hashes), -1, np.int64)
        if not len(self.hashes):
            return found
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = self.order[at].astype(np.int64)
        sizes = np.diff(borders)
        same = (self.hashes[at] == hashes) & (np.diff(self.borders)[number] == sizes)
        chosen = np.flatnonzero(same)
        ours, places = picked(data, borders, chosen)
        first = np.repeat(self.borders[number[chosen]] - places[:-1], sizes[chosen])
        differ = np.add.reduceat(ours != self.text[first + np.arange(len(ours))], places[:-1]) if len(ours) else 0
        chosen = chosen[differ == 0]
        found[chosen] = number[chosen]
        return found


def picked(values: np.ndarray, borders: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of values between some borders, one after the other, and their own borders."""
    sizes = borders[chosen + 1] - borders[chosen]
    own = np.concatenate(([0], np.cumsum(sizes)))
    return values[np.repeat(borders[chosen] - own[:-1], sizes) + np.arange(own[-1])], own


class Encoder:
    """Encodes runs of texts with a tokenizers file, without special tokens added.

    Texts are cut where no token of the tokenizer can reach across: before white space that follows a
    letter or mark, and between a letter and a mark (not an apostrophe). A run's distinct chunks that
    are not known from an earlier run are encoded once and the ids dealt back to the texts. A text that spells a special token is encoded
    whole, as the tokenizer finds special tokens before it splits.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [text.encode() for text in special]
        self.classes = byte_classes()
        self.byte_letters = byte_letters()
        self.chunks = Chunks()
        # a tokenizer that drops white space and lower-cases takes chunks without either
        self.plain = self.encode_all(["A b"]) == self.encode_all(["a\nb"])

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [one.ids for one in found]

    def kinds(self, data: np.ndarray) -> np.ndarray:
        """The class of each byte."""
        kind = self.classes[data]
        # both bytes of a Latin-1 letter count as letter; not the signs for times and division
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        return kind

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """True at each byte that starts a chunk."""
        kind = self.kinds(data)
        before, after = kind[:-1], kind[1:]
        cut = ((before == LETTER) | (before == MARK)) & (after == SPACE)
        cut |= (before == LETTER) & (after == MARK) | (before == MARK) & (after == LETTER)
        if self.plain:
            cut |= (before == SPACE) & ((after == LETTER) | (after == MARK))
        starts = np.zeros(len(data), bool)
        starts[1:] = cut
        return starts

    def chunk_ids(self, chunks: list[bytes]) -> list[list[int]]:
        """Ids of each chunk; only letters, or marks, after at most a space go straight to the model."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        firsts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(chunks), np.uint8)
        kind = self.kinds(data)
        spaces, letters, marks = (np.add.reduceat(kind == one, firsts, dtype=np.int64) for one in (SPACE, LETTER, MARK))
        blank = self.plain & (spaces == sizes)
        bare = sizes - ((data[firsts] == 32) & (not self.plain))
        simple = (bare > 0) & ((letters == bare) | (marks == bare))

        ids: list = [[] for _ in chunks]
        places = np.flatnonzero(simple).tolist()
        text = "\n".join([chunks[i].decode() for i in places])
        text = (text.lower() if self.plain else text).encode().decode("latin-1")
        for letter in set(text) - {"\n"}:
            text = text.replace(letter, self.byte_letters[ord(letter)])
        tokenize = self.tokenizer.model.tokenize
        for i, word in zip(places, text.split("\n")):  # without places the text is one empty word
            ids[i] = [token.id for token in tokenize(word)]
        rest = np.flatnonzero(~simple & ~blank).tolist()
        whole = self.encode_all([chunks[i].decode("utf-8", "replace") for i in rest])
        for i, found in zip(rest, whole, strict=True):
            ids[i] = found
        return ids

    def encode(self, data: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in one array, and the texts' borders in it; takes UTF-8 bytes."""
        size = len(borders) - 1
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(size + 1, np.int64)
        raw = data.tobytes()
        whole = np.zeros(size, bool)
        if any(special in raw for special in self.special):
            texts = [raw[borders[i] : borders[i + 1]] for i in range(size)]
            whole = np.array([any(special in text for special in self.special) for text in texts])
        # lower case first makes fewer chunks; where accents are letters of their own, it could change
        # what the normaliser composes
        if self.plain and b"\xcc" not in raw and b"\xcd" not in raw:
            data = np.frombuffer(raw.lower(), np.uint8)
        starts = self.cuts(data)
        starts[borders[:-1][np.diff(borders) > 0]] = True
        starts = np.flatnonzero(starts)
        offsets = np.append(starts, len(data)).astype(np.int32)
        chunks = pa.Array.from_buffers(
            pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        _, places, joined = chunks.dictionary.buffers()
        places = np.frombuffer(places, np.int32, len(chunks.dictionary) + 1).astype(np.int64)
        joined = np.frombuffer(joined, np.uint8, places[-1])
        which = self.chunks.numbers(joined, places, self.chunk_ids)[chunks.indices.to_numpy()]
        taken, ends = picked(self.chunks.ids, self.chunks.id_borders, which)
        taken, ends = taken.astype(np.int64), ends[np.searchsorted(starts, borders)]
        if whole.any():
            parts = np.split(taken, ends[1:-1])
            for i in np.flatnonzero(whole):
                text = raw[borders[i] : borders[i + 1]].decode("utf-8", "replace")
                parts[i] = np.array(self.encode_all([text])[0], np.int64)
            taken = np.concatenate(parts)
            ends = np.concatenate(([0], np.cumsum([len(part) for part in parts])))
        return taken, ends


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file; the file lies at that path on every machine."""
    return Encoder(path)
