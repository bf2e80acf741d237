"""Byte-pair encoding of whole texts by reuse of content-defined passages, with repaired joins, and decoding.

A hash over the last bytes decides between which characters a text is cut, so equal passages of some hundred words are cut
alike wherever they stand. Each task keeps a bounded dictionary from a passage's hash to its ids; only passages not met
before are encoded, from a second dictionary of their words. A place is an exact cut where white space follows a character that
is none: the pre-tokenizer breaks there whatever follows, and what it finds on either side does not depend on the other.
Hardly any join of two passages is such a place, as they are cut inside words too, so joins are repaired: the text around a join is encoded as one,
from an exact cut to an exact cut, with a neighbouring stretch on either side. Where the ids of both stretches equal those of
the passages, the new ids take the place of the old; else the window is widened, at most to the whole text.
``encoder`` finally decodes the ids and compares them with the text; a text that
differs (only a hash collision could do that) is encoded whole.

Null texts count as empty and have no ids. Every row is encoded by itself: repeated rows and null
ids are kept. Long texts are cut like others; memory follows the longest text of a batch. Other
columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from strandline.llm import wordhash

GROUP = 1 << 20
MAX_CHUNKS = 400_000
#: Bytes that decide about a cut, and the bits of their hash that must be zero: passages of some 1,024 bytes.
WINDOW, JOIN_BITS = 8, 10
#: Ids that the dictionary of passages holds, for each word that the other one may.
IDS_KEPT = 10
#: Between chunks that are encoded as one text: a word of its own, whose one id tells them apart again.
BETWEEN, TOGETHER = " \x1f ", 256
#: UTF-8 ends of white space outside ASCII (byte before last, last byte; third-last checked apart).
_WIDE = {(0xC2, 0x85), (0xC2, 0xA0), (0x9A, 0x80), (0x81, 0x9F), (0x80, 0x80), *((0x80, b) for b in (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF))}
_WIDE_END = np.zeros(256, bool)
_WIDE_END[[b for _, b in _WIDE]] = True
_GAP = wordhash._SPACE.copy()
_MARK, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_CONTROL = _GAP.copy()
_CONTROL[0x1C:0x20] = True


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its count, one after the other."""
    total = np.cumsum(counts)
    return np.repeat(starts - (total - counts), counts) + np.arange(total[-1] if len(total) else 0)


class Store:
    """Ids of byte strings under the strings' hashes, one after the other in one array."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.starts, self.lengths, self.flat = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64), np.empty(1 << 18, np.uint32)
        self.used = 0

    def codes(self, hashes: list[int], encode) -> np.ndarray:
        """Places of the hashes; ``encode`` is given the numbers of those not met before, each once, and returns their ids and how many each has."""
        known = self.known
        codes = np.fromiter(map(known.get, hashes, repeat(-1)), np.int64, len(hashes))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            new = list({hashes[i]: i for i in missing.tolist()}.values())
            fresh, sizes = encode(np.array(new))
            count, end = len(known), self.used + len(fresh)
            while count + len(new) > len(self.starts):
                self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
            while end > len(self.flat):
                self.flat = np.resize(self.flat, 2 * len(self.flat))
            self.flat[self.used : end] = fresh
            self.starts[count : count + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.lengths[count : count + len(new)] = sizes
            self.used = end
            for k, i in enumerate(new):
                known[hashes[i]] = count + k
            codes[missing] = [known[hashes[i]] for i in missing.tolist()]
        return codes

    def ids(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids at the places, one after the other, and how many each has."""
        n = self.lengths[codes]
        return self.flat[_ranges(self.starts[codes], n)], n


class Chunks:
    """Ids of texts by their passages and words.

    ``repair`` off is for vocabularies of lower-cased words that drop white space: every cut at white space, and
    between a letter and a full stop or the like, is exact there, so words alone are kept, and those that differ in case of A-Z are one.
    """

    def __init__(self, path: str, repair: bool = True, most: int = MAX_CHUNKS):
        self.tokenizer, self.repair, self.most = _load(path), repair, most
        #: Windows around joins that were encoded anew.
        self.repaired = 0
        self.between = None if repair else self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.widths = kept(Pieces, path).lengths if repair else None
        self.words, self.passages = Store(), Store()

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[np.ndarray] = []
        group: list[bytes] = []
        size = 0
        for text in texts:
            if group and size + len(text) > GROUP:
                out += self._group(group)
                group, size = [], 0
            group.append(text)
            size += len(text)
        return out + self._group(group) if group else out

    def _group(self, texts: list[bytes]) -> list[np.ndarray]:
        joined = b"".join(texts)
        if not joined:
            return [np.empty(0, np.uint32) for _ in texts]
        raw = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        begins = ends - np.array([len(t) for t in texts])
        firsts = begins[begins < ends]
        if not self.repair:
            flat, bounds = self._by_words(joined, raw, np.append(begins, len(raw)))
        elif (flat := self._by_passages(joined, raw, firsts)) is None:
            return [np.array(self.tokenizer.encode(t.decode("utf-8"), add_special_tokens=False).ids, np.uint32) for t in texts]
        else:
            bounds = np.searchsorted(self._places(flat), np.append(begins, len(raw)))
        return [flat[a:b] if e > s else flat[:0] for a, b, s, e in zip(bounds[:-1], bounds[1:], begins, ends)]

    def _places(self, flat: np.ndarray) -> np.ndarray:
        """Where each id's bytes begin, and where the last one's end."""
        return np.concatenate(([0], np.cumsum(self.widths[flat])))

    def _hashes(self, raw: np.ndarray, starts: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Hashes and lengths of the strings that begin at ``starts``."""
        lengths = np.diff(np.append(starts, len(raw)))
        power = wordhash._POWER if lengths.max() <= 256 else np.cumprod(np.full(lengths.max(), wordhash._BASE, np.uint64))
        value = wordhash._BYTE[raw] * power[np.arange(len(raw)) - np.repeat(starts, lengths)]
        return wordhash.mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64)).tolist(), lengths

    def _borders(self, raw: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Starts of the passages: the texts' own starts, and places between characters that the hash of the last bytes names."""
        begun = np.zeros(len(raw), bool)
        if len(raw) > WINDOW:
            last = np.ndarray(len(raw) - WINDOW, "<u8", raw, strides=(1,))
            at = WINDOW + np.flatnonzero((last * wordhash._BASE) >> np.uint64(64 - JOIN_BITS) == 0)
            at = at[(raw[at] & 0xC0) != 0x80]
            # the last bytes are the text's own, or equal passages would be cut otherwise after other texts
            begun[at[at - firsts[np.searchsorted(firsts, at, "right") - 1] >= WINDOW]] = True
        begun[firsts] = True
        return np.flatnonzero(begun)

    def _open(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which of the strings before ``ends`` end in white space, or in what might count as such."""
        last = raw[ends - 1]
        open_ = _CONTROL[last]
        wide = np.flatnonzero(_WIDE_END[last] & (ends > 1))
        if len(wide):
            open_[wide] = [pair in _WIDE for pair in zip(raw[ends[wide] - 2].tolist(), last[wide].tolist())]
        return open_

    def _exact(self, raw: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Where no id can reach across, whatever stands on either side, and the given starts."""
        begun = _GAP[raw]
        if self.repair:
            at = np.flatnonzero(begun)
            at = at[at > 0]
            begun[at[self._open(raw, at)]] = False
        else:
            # this vocabulary's words are runs of letters, lower-cased, and white space vanishes: all these cuts are exact
            marks = np.flatnonzero(_MARK[raw])
            marks = marks[marks > 0]
            begun[marks[_LETTER[raw[marks - 1]]]] = True
        begun[firsts] = True
        return np.flatnonzero(begun)

    def _by_words(self, joined: bytes, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings between ``bounds``, each by itself, one after the other, and the bounds of each one's ids."""
        if len(self.words.known) > self.most:
            self.words.clear()
        starts = self._exact(raw, bounds[:-1][bounds[:-1] < bounds[1:]])
        # control strings alone tell cases apart
        hashes, lengths = self._hashes(raw if self.repair or b"<|" in joined else wordhash._LOWER[raw], starts)

        def encode(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pieces = [joined[s : s + n] for s, n in zip(starts[new].tolist(), lengths[new].tolist())]
            if not self.repair:
                return self._together([p.decode("utf-8") for p in pieces])
            return self._in_rows(pieces, _GAP[raw[starts[new]]] & ~self._open(raw, starts[new] + lengths[new]))

        flat, n = self.words.ids(self.words.codes(hashes, encode))
        return flat, np.concatenate(([0], np.cumsum(n)))[np.searchsorted(starts, bounds)]

    def _by_passages(self, joined: bytes, raw: np.ndarray, firsts: np.ndarray) -> np.ndarray | None:
        """Ids of texts that begin at ``firsts``, one after the other; None if a dictionary has ids of other strings than asked for."""
        if self.passages.used > IDS_KEPT * self.most:
            self.passages.clear()
        starts = self._borders(raw, firsts)
        hashes, lengths = self._hashes(raw, starts)

        def encode(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            text = b"".join(joined[s : s + n] for s, n in zip(starts[new].tolist(), lengths[new].tolist()))
            ids, bounds = self._by_words(text, np.frombuffer(text, np.uint8), np.concatenate(([0], np.cumsum(lengths[new]))))
            return ids, np.diff(bounds)

        flat, n = self.passages.ids(self.passages.codes(hashes, encode))
        if not np.array_equal(self._places(flat)[np.cumsum(n)], starts + lengths):
            return None
        exact = np.append(self._exact(raw, firsts), len(raw))
        joins = starts[~np.isin(starts, exact, assume_unique=True)]
        return self._mended(joined, flat, joins, exact, np.searchsorted(exact, np.append(firsts, len(raw)))) if len(joins) else flat

    def _mended(self, joined: bytes, flat: np.ndarray, joins: np.ndarray, exact: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """``flat`` with the ids around ``joins`` encoded anew; windows, and the bounds of texts, are numbers of exact cuts."""
        places = self._places(flat)
        right = np.searchsorted(exact, joins)
        left, step = right - 1, 1
        while True:
            text = np.searchsorted(texts, left, "right")
            outer, after = np.maximum(left - 1, texts[text - 1]), np.minimum(right + 1, texts[text])
            # windows that overlap become one
            reach = np.maximum.accumulate(after)
            head = np.flatnonzero(np.concatenate(([True], outer[1:] >= reach[:-1])))
            left, right = np.minimum.reduceat(left, head), np.maximum.reduceat(right, head)
            outer, after, text = np.minimum.reduceat(outer, head), np.maximum.reduceat(after, head), text[head]
            bytes_ = [joined[a:b].decode("utf-8") for a, b in zip(exact[outer].tolist(), exact[after].tolist())]
            new, n = self._separate(bytes_)
            edges = [exact[k] for k in (outer, left, right, after)]
            old = [np.searchsorted(places, e) for e in edges]
            met = np.all([places[o] == e for o, e in zip(old, edges)], axis=0)
            # places of the new ids, counted over all windows
            begin, at = np.cumsum(n) - n, self._places(new)
            shift = at[begin] - edges[0]
            inner, beyond = (np.searchsorted(at, e + shift) for e in edges[1:3])
            met &= (inner - begin == old[1] - old[0]) & (begin + n - beyond == old[3] - old[2])
            for mine, theirs, count in ((begin, old[0], old[1] - old[0]), (beyond, old[2], old[3] - old[2])):
                count = np.where(met, count, 0)
                differs = new[_ranges(mine, count)] != flat[_ranges(theirs, count)]
                met &= np.bincount(np.repeat(np.arange(len(count)), count)[differs], minlength=len(count)) == 0
            if met.all():
                break
            left = np.where(met, left, np.maximum(left - step, texts[text - 1]))
            right = np.where(met, right, np.minimum(right + step, texts[text]))
            step *= 2
        self.repaired += len(n)
        out = np.ones(len(flat) + 1, bool)
        out[_ranges(old[0], old[3] - old[0])] = False
        kept_before = np.concatenate(([0], np.cumsum(out)))[old[0]]
        return np.insert(flat[out[:-1]], np.repeat(kept_before, n), new)

    def _separate(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]
        sizes = np.array([len(x) for x in ids], np.int64)
        return np.fromiter((i for x in ids for i in x), np.uint32, int(sizes.sum())), sizes

    def _in_rows(self, pieces: list[bytes], closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, where ``closed`` pieces begin at an exact cut and end before one: such are given to the tokenizer as one text."""
        rows, alone = np.flatnonzero(closed).tolist(), np.flatnonzero(~closed).tolist()
        flat, sizes = self._separate([pieces[i].decode("utf-8") for i in alone])
        parts, order = [flat], [alone]
        counts = [sizes]
        for at in range(0, len(rows), TOGETHER):
            part = [pieces[i] for i in rows[at : at + TOGETHER]]
            (found,) = self.tokenizer.encode_batch_fast([b"".join(part).decode("utf-8")], add_special_tokens=False)
            ids, ends = np.array(found.ids, np.uint32), np.cumsum([len(p) for p in part])
            places = self._places(ids)
            bounds = np.searchsorted(places, ends)
            if bounds[-1] != len(ids) or not np.array_equal(places[bounds], ends):
                ids, n = self._separate([p.decode("utf-8") for p in part])
            else:
                n = np.diff(bounds, prepend=0)
            parts.append(ids)
            counts.append(n)
            order.append(rows[at : at + TOGETHER])
        ids, n = np.concatenate(parts), np.concatenate(counts)
        back = np.argsort(np.concatenate([np.array(o, np.int64) for o in order]))
        return ids[_ranges((np.cumsum(n) - n)[back], n[back])], n[back]

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that white space may be put around; most of their time goes into each single call otherwise."""
        flat, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for at in range(0, len(pieces), TOGETHER):
            part = pieces[at : at + TOGETHER]
            (found,) = self.tokenizer.encode_batch_fast([BETWEEN.join((*part, ""))], add_special_tokens=False)
            ids = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(ids == self.between[0])
            if len(self.between) != 1 or len(ends) != len(part):
                # the separator is no single id, or stands in a piece too
                ids, counts = self._separate(part)
            else:
                ids, counts = np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
            flat.append(ids)
            sizes.append(counts)
        return np.concatenate(flat), np.concatenate(sizes)


class Pieces:
    """Bytes of ids of a byte-level vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        # the printable stand-ins of byte-level vocabularies: printable Latin-1 stands for itself, the rest follows from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        stand = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        table = {i: bytes(stand[c] for c in word) for word, i in model["model"]["vocab"].items()}
        table |= {t["id"]: t["content"].encode() for t in model["added_tokens"]}
        size = max(table) + 1
        self.lengths = np.array([len(table.get(i, b"")) for i in range(size)], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(table.get(i, b"") for i in range(size)), np.uint8)

    def decode(self, ids: np.ndarray) -> bytes:
        n = self.lengths[ids]
        total = np.cumsum(n)
        if not len(total):
            return b""
        return self.flat[np.repeat(self.starts[ids] - (total - n), n) + np.arange(total[-1])].tobytes()


_KEPT: dict = {}


def kept(kind, path: str, *args):
    """One encoder or table per Python worker, reused by its tasks."""
    key = (kind.__name__, path, args)
    if key not in _KEPT:
        _KEPT[key] = kind(path, *args)
    return _KEPT[key]


def in_groups(batch: pa.RecordBatch, size: int = 2 * GROUP) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of rows of about ``size`` bytes at a time."""
    texts = batch.column(1).cast(pa.large_binary())
    names = batch.column(0).to_pylist()
    at = 0
    while at < len(names):
        group, total = [], 0
        while at + len(group) < len(names) and (not group or total < size):
            group.append(texts[at + len(group)].as_py() or b"")
            total += len(group[-1])
        yield names[at : at + len(group)], group
        at += len(group)


def _ids(parts: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat))


ENCODED = "doc_id long, ids array<int>"


def encoder(path: str):
    """A mapInArrow function: doc_id, text -> ENCODED, exactly as the tokenizer encodes without special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, pieces = kept(Chunks, path), kept(Pieces, path)
        for batch in batches:
            for names, texts in in_groups(batch):
                ids = chunks.encode(texts)
                for k, text in enumerate(texts):
                    if pieces.decode(ids[k]) != text:
                        ids[k] = np.array(chunks.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, np.uint32)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), _ids(ids)], ["doc_id", "ids"])

    return run


def decoder(path: str):
    """A mapInArrow function: doc_id, ids -> doc_id, ids, text. Bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = kept(Pieces, path)
        for batch in batches:
            lists = batch.column(1)
            step = max(1, 500_000 // max(1, len(lists.flatten()) // max(1, len(lists))))
            for at in range(0, len(lists), step):
                part = lists.slice(at, step)
                flat, offsets = part.flatten().to_numpy(zero_copy_only=False), np.asarray(part.offsets) - part.offsets[0].as_py()
                texts = [pieces.decode(flat[a:b]).decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, step), part, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return run


def round_trip(path: str):
    """A mapInArrow function: doc_id, text -> doc_id, ids, text: encoder and decoder one after the other in one worker."""
    encode, decode = encoder(path), decoder(path)
    return lambda batches: decode(encode(batches))
