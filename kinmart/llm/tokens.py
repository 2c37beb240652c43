"""Token ids of whole texts, by a public tokenizer file.

Both kinds of file in use here (byte-level BPE and lower-casing word BPE) cut a text before
every run of blanks: no token, merge, look-ahead or normal form reaches from a non-blank
character over a following blank. A text that holds no other white space than space and line
feed is therefore the chain of its units, blanks with the word after them, and the ids of a
unit never depend on its neighbours. Arrow cuts a block of texts into units and numbers the
distinct ones; the tokenizer library encodes those it has not met of late, and numpy lays the
ids of the units end to end. Any other text goes to the library whole.

What a worker keeps between blocks is bounded by ``KEPT_BYTES``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

UNIT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space of Unicode and of Python, but for space and line feed (fixed values).
OTHER_SPACE = (
    "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u180e\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
#: Stand before a unit in place of what comes before it: a line feed, the start of the text or
#: of a unit cut otherwise. A unit without one of these comes after a space.
AFTER_LINE, AT_START = "\x01", "\x02"
#: Signs that begin a token of their own after a plain letter or digit, in either kind of file.
CLOSING = ".,;:!?"
CLOSED = r"[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}][.,;:!?]$"
#: Bytes a worker keeps of units and their ids.
KEPT_BYTES = 32 << 20
#: Bytes of text handled at a time.
BLOCK_BYTES = 8 << 20
#: New units the library encodes as one text.
JOINED = 512


def blocks_of(texts: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Array]:
    """Slices of a column, each of about ``block_bytes`` or of a single text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes, dtype=np.int64) - sizes) // block_bytes
    cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(texts)]
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            yield texts.slice(low, high - low)


def stretches(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[first : first + size]`` of every row, end to end."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    # The largest array of a block has one number for each of its ids.
    small = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    places = np.repeat((first - (ends - sizes)).astype(small), sizes)
    places += np.arange(total, dtype=small)
    return flat[places]


class UnitIds:
    """The ids of units met of late, in arrays: no Python object is kept for a unit.

    When they take more than ``kept_bytes``, those met longest ago are forgotten.
    """

    def __init__(self, tokenizer, before: dict[str, str], default: str, kept_bytes: int):
        self.tokenizer, self.before, self.default = tokenizer, before, default
        self.kept_bytes, self.turn = kept_bytes, 0
        self.words = pa.array([], pa.string())
        self.first, self.sizes, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, "<u4")
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.border = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            # Byte-level files write space and line feed as these letters; word BPE marks ends.
            at_blank = token[:1] in ("\u0120", "\u010a")
            self.border[number] = at_blank if default else token.endswith("</w>")

    def library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of texts, each encoded by itself."""
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        lists = [one.ids for one in made]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), "<u4", int(sizes.sum())), sizes

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same, many encoded as one text and told apart by their border tokens.

        Only for texts of which each has exactly one such token; else they are encoded singly.
        """
        flat, sizes, last = [], [], self.default == ""
        for low in range(0, len(texts), JOINED):
            own = texts[low : low + JOINED]
            whole = (" " if last else "").join(own)
            made = self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)
            ids = np.array(made[0].ids, "<u4")
            edges = np.flatnonzero(self.border[ids])
            if len(edges) == len(own):
                cuts = np.r_[0, edges + 1] if last else np.r_[edges, len(ids)]
                counts = np.diff(cuts)
            else:
                ids, counts = self.library(own)
            flat.append(ids)
            sizes.append(counts)
        return np.concatenate(flat), np.concatenate(sizes)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, sizes) of units none of which is known."""
        before, default = self.before, self.default
        if default:
            clean = [word[:1] != AT_START for word in words]
            words = [
                before[word[:1]] + word[1:] if word[:1] in before else default + word
                for word in words
            ]
        else:
            clean = [word.isalpha() for word in words]
        first, sizes = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        flat, at, clean = [], 0, np.array(clean, bool)
        for some, method in ((clean, self.joined), (~clean, self.library)):
            places = np.flatnonzero(some)
            if not len(places):
                continue
            ids, counts = method([words[k] for k in places.tolist()])
            first[places] = np.cumsum(counts) - counts + at
            sizes[places] = counts
            at += len(ids)
            flat.append(ids)
        return np.concatenate(flat), first, sizes

    def look_up(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(flat, first, sizes): where the ids of each of some distinct units are."""
        self.turn += 1
        found = pc.fill_null(pc.index_in(units, value_set=self.words), -1)
        places = found.to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(places < 0)
        self.met[places[places >= 0]] = self.turn
        if len(new):
            names = units.take(pa.array(new))
            ids, first, sizes = self.encode(names.to_pylist())
            places[new] = len(self.words) + np.arange(len(new))
            self.words = pa.concat_arrays([self.words, names])
            self.first = np.concatenate([self.first, first + len(self.flat)])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.met = np.concatenate([self.met, np.full(len(new), self.turn)])
            self.flat = np.concatenate([self.flat, ids])
        answer = self.flat, self.first[places], self.sizes[places]
        if self.held_bytes > self.kept_bytes:
            self.forget()
        return answer

    @property
    def held_bytes(self) -> int:
        return self.words.nbytes + self.flat.nbytes + 24 * len(self.words)

    def forget(self) -> None:
        """Keep the units met last, in about half of the bytes allowed."""
        n = int(len(self.words) * self.kept_bytes / (2 * self.held_bytes))
        kept = np.sort(np.argsort(-self.met, kind="stable")[:n])
        self.words = self.words.take(pa.array(kept))
        self.flat = stretches(self.flat, self.first[kept], self.sizes[kept])
        self.sizes, self.met = self.sizes[kept], self.met[kept]
        self.first = np.cumsum(self.sizes) - self.sizes


class Encoder:
    """Whole texts to ids."""

    def __init__(self, tokenizer, kept_bytes: int = KEPT_BYTES):
        self.tokenizer = tokenizer
        marks = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        self.lowers = "Lowercase" in json.dumps(json.loads(tokenizer.to_str())["normalizer"])
        blank = [self.whole(text).tolist() for text in ("a b", "\n a\n\n b ")]
        self.blanks_vanish = blank[0] == blank[1]
        before = {} if self.blanks_vanish else {AFTER_LINE: "\n", AT_START: ""}
        default = "" if self.blanks_vanish else " "
        self.units = UnitIds(tokenizer, before, default, kept_bytes)
        ids, sizes = self.units.library(["", *CLOSING])
        self.signs = ids, np.cumsum(sizes) - sizes, sizes
        escaped = "|".join(re.escape(mark) for mark in marks if mark)
        self.odd = f"[{OTHER_SPACE}{AFTER_LINE}{AT_START}]" + (f"|{escaped}" if escaped else "")
        self.loose = r"  | \n|\n |\n\n|\A[ \n]|[ \n]\z"

    def whole(self, text: str) -> np.ndarray:
        """Ids of a text as the library gives them."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def by_unit(self, text: str) -> np.ndarray:
        """Ids of a text with runs of blanks, unit by unit."""
        units = pa.array([AT_START + unit for unit in UNIT.findall(text)], pa.string())
        numbered = units.dictionary_encode()
        flat, first, sizes = self.units.look_up(numbered.dictionary)
        which = numbered.indices.to_numpy(zero_copy_only=False)
        return stretches(flat, first[which], sizes[which])

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return self.encode_block(pa.array([text], pa.string()))[0]

    def encode_block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts): ids of all texts end to end, and where each begins, with the end.

        A null text is empty.
        """
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, self.odd)
        loose = None if self.blanks_vanish else pc.match_substring_regex(texts, self.loose)
        apart = odd if loose is None else pc.or_(odd, loose)
        single = np.flatnonzero(apart.to_numpy(zero_copy_only=False))
        plain = pc.if_else(apart, "", texts) if len(single) else texts
        ids, starts = self.chains(plain)
        if not len(single):
            return ids, starts
        parts, at = [], 0
        for k in single.tolist():
            parts.append(ids[starts[at] : starts[k]])
            own = self.whole if odd[k].as_py() else self.by_unit
            parts.append(own(texts[k].as_py()))
            at = k
        parts.append(ids[starts[at] :])
        counts = np.diff(starts)
        counts[single] = [len(part) for part in parts[1::2]]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(counts)])

    def chains(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of texts in which single spaces and line feeds divide the units."""
        if self.blanks_vanish:
            if self.lowers:
                # Lower-casing ahead of the tokenizer is the same where no mark combines.
                wide = pc.match_substring_regex(texts, r"[^\x00-\x{ff}]")
                texts = pc.if_else(wide, texts, pc.ascii_lower(texts))
            lists = pc.ascii_split_whitespace(texts)
        else:
            lines = pc.replace_substring(texts, "\n", " " + AFTER_LINE)
            lists = pc.split_pattern(pc.binary_join_element_wise(AT_START, lines, ""), " ")
        numbered = lists.flatten().dictionary_encode()
        flat, ends = self.distinct_ids(numbered.dictionary)
        which = numbered.indices.to_numpy(zero_copy_only=False)
        sizes = np.diff(ends)[which]
        ids = stretches(flat, ends[:-1][which], sizes)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        offsets = lists.offsets.to_numpy(zero_copy_only=False)
        return ids, starts[offsets - offsets[0]]

    def distinct_ids(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of distinct units: each is a stem, looked up, and maybe a closing sign."""
        closed = pc.match_substring_regex(units, CLOSED)
        sign = pc.if_else(closed, pc.utf8_slice_codeunits(units, -1), "")
        sign = pc.index_in(sign, value_set=pa.array(["", *CLOSING]))
        sign = sign.to_numpy(zero_copy_only=False)
        stems = pc.if_else(closed, pc.utf8_slice_codeunits(units, 0, -1), units)
        stems = stems.dictionary_encode()
        stem = stems.indices.to_numpy(zero_copy_only=False)
        flat, first, sizes = self.units.look_up(stems.dictionary)
        both = np.concatenate([self.signs[0], flat])
        firsts, counts = (np.empty(2 * len(units), np.int64) for _ in range(2))
        firsts[::2], counts[::2] = first[stem] + len(self.signs[0]), sizes[stem]
        firsts[1::2], counts[1::2] = self.signs[1][sign], self.signs[2][sign]
        ids = stretches(both, firsts, counts)
        return ids, np.concatenate([[0], np.cumsum(counts)[1::2]])


def with_end(ids: np.ndarray, starts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same block with ``end_id`` after each text."""
    return np.insert(ids, starts[1:], end_id), starts + np.arange(len(starts))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file in a worker; it outlives a task, and only one is kept."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Encoder(Tokenizer.from_file(path))


@lru_cache(maxsize=4)
def vocabulary_size(path: str) -> int:
    """Ids run from 0 to this number, exclusive."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab(with_added_tokens=True).values()) + 1
