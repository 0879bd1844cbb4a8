"""Token ids of whole texts by the tokenizers library, each word piece encoded once by a worker.

A byte-level vocabulary splits a text before merging, and no piece runs over a space that follows a non-space
character. So a text is cut there, equal pieces of a batch are found by Arrow, pieces not met before are encoded in long
runs, and the ids are laid out by array operations. Texts with a space between other white space are cut by a pattern
that keeps runs of white space whole. Pieces and ids stay in arrays throughout; no piece becomes a Python object but
the few that cannot be put into a run.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space beyond ASCII, and separators that count as such in some libraries.
_WHITE = r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: A space beside white space on both sides, where cutting at every space would part a run; and how such texts are cut.
RUN = f"(?:{_WHITE}|^) (?:{_WHITE}|$)"
CUT = re.compile(r"(?<=\S)(?= )")
#: Pieces that a worker remembers; of more, those that were not met for longest go.
REMEMBERED = 300_000
#: Pieces encoded in one run.
IN_RUN = 2000


def _worker_store() -> dict:
    """A dictionary that lives as long as the Python worker."""
    return sys.modules.setdefault("tallywise_worker_store", types.ModuleType("tallywise_worker_store")).__dict__


def joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and offsets of several lists of pieces, one behind the other."""
    ids = np.concatenate([x for x, _ in parts])
    sizes = np.concatenate([np.diff(at) for _, at in parts])
    at = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=at[1:])
    return ids, at


def taken(ids: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the chosen pieces one behind the other, and their offsets."""
    size = at[which + 1] - at[which]
    ends = np.zeros(len(which) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    return ids[np.repeat(at[which] - ends[:-1], size) + np.arange(ends[-1])], ends


class Known:
    """Pieces met before with their ids."""

    def __init__(self):
        self.pieces = pa.array([], pa.large_string())
        self.ids, self.at = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self.met, self.turn = np.zeros(0, np.int64), 0

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Place of each piece, -1 if it is new."""
        self.turn += 1
        place = pc.fill_null(pc.index_in(pieces, value_set=self.pieces), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.met[place[place >= 0]] = self.turn
        return place

    def add(self, pieces: pa.Array, ids: np.ndarray, at: np.ndarray) -> None:
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.ids, self.at = joined([(self.ids, self.at), (ids, at)])
        self.met = np.concatenate((self.met, np.full(len(pieces), self.turn)))

    def trim(self, most: int) -> None:
        if len(self.pieces) > most:
            keep = np.sort(np.argsort(-self.met, kind="stable")[: most // 2])
            self.pieces, self.met = self.pieces.take(pa.array(keep)), self.met[keep]
            self.ids, self.at = taken(self.ids, self.at, keep)


class Encoder:
    """Encodes with the vocabulary file at ``path``, without adding special tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        store = _worker_store().setdefault(f"vocabulary:{path}", {})
        if not store:
            tokenizer = Tokenizer.from_file(path)
            opens = np.zeros(tokenizer.get_vocab_size(), bool)
            for token, i in tokenizer.get_vocab().items():
                opens[i] = token.startswith("Ġ")  # how byte-level vocabularies write a space
            store |= {"tokenizer": tokenizer, "opens": opens, " ": Known(), "": Known()}
        self.store, self.tokenizer = store, store["tokenizer"]

    def _each(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        at = np.zeros(len(found) + 1, np.int64)
        np.cumsum([len(x) for x in found], out=at[1:])
        return np.array([i for x in found for i in x], np.uint32), at

    def _run(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that each stand behind a space and begin with no white space, encoded as one text."""
        text = " " + " ".join(pieces.to_pylist())
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        begins = np.flatnonzero(self.store["opens"][ids])
        if len(begins) == len(pieces) and begins[0] == 0:
            return ids, np.append(begins, len(ids))
        return self._each([" " + x for x in pieces.to_pylist()])

    def _encoded(self, pieces: pa.Array, prefix: str) -> tuple[np.ndarray, np.ndarray]:
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        plain = np.zeros(len(pieces), bool)
        if prefix:
            first = pc.utf8_slice_codeunits(pieces, 0, 1)
            odd = pc.or_(pc.or_(pc.utf8_is_space(first), pc.match_substring_regex(first, _WHITE)), pc.match_substring(pieces, " "))
            plain = pc.and_(pc.not_equal(pieces, ""), pc.invert(odd)).to_numpy(zero_copy_only=False)
        runs, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        parts = [self._run(pieces.take(pa.array(runs[lo : lo + IN_RUN]))) for lo in range(0, len(runs), IN_RUN)]
        if len(rest):
            parts.append(self._each([prefix + x for x in pieces.take(pa.array(rest)).to_pylist()]))
        ids, at = joined(parts)
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate((runs, rest))] = np.arange(len(pieces))
        return taken(ids, at, order)

    def _of_pieces(self, flat: pa.Array, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the pieces, and the ids of the distinct ones with their offsets."""
        coded = flat.dictionary_encode()
        names, known = coded.dictionary, self.store[prefix]
        place = known.find(names)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(known.pieces) + np.arange(len(new))
            fresh = names.take(pa.array(new))
            known.add(fresh, *self._encoded(fresh, prefix))
        ids, at = taken(known.ids, known.at, place)
        known.trim(REMEMBERED)
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), ids, at

    def encode(self, texts: pa.Array | list) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and the offset of each text; null is empty."""
        texts = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        parts = pc.split_pattern(texts, " ")
        odd = pc.match_substring_regex(texts, RUN).to_numpy(zero_copy_only=False)
        if odd.any():
            some = texts.filter(pa.array(odd)).to_pylist()
            cut = [[got[0]] + [x[1:] for x in got[1:]] for got in map(CUT.split, some)]
            both = pa.concat_arrays([parts.filter(pa.array(~odd)), pa.array(cut, parts.type)])
            order = np.empty(len(odd), np.int64)
            order[np.concatenate((np.flatnonzero(~odd), np.flatnonzero(odd)))] = np.arange(len(odd))
            parts = both.take(pa.array(order))
        flat = parts.flatten()
        begin = np.asarray(parts.offsets).astype(np.int64)
        begin = begin - begin[0]
        code, ids, at = self._of_pieces(flat, " ")
        first = begin[:-1]
        first_code, first_ids, first_at = self._of_pieces(flat.take(pa.array(first)), "")
        code[first] = first_code + len(at) - 1
        out, ends = taken(*joined([(ids, at), (first_ids, first_at)]), code)
        return out, ends[begin]


def gathered(batches, size: int):
    """Record batches of about the given bytes, of smaller ones one behind the other; a larger one stays as it is."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield held[0] if len(held) == 1 else pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield held[0] if len(held) == 1 else pa.concat_batches(held)


def byte_runs(texts: pa.Array, size: int):
    """(from, to) of runs of texts of about the given bytes together; a longer text stands alone."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    lo, total = 0, 0
    for i, n in enumerate(length.tolist()):
        if i > lo and total + n > size:
            yield lo, i
            lo, total = i, 0
        total += n + 1
    if len(length) > lo:
        yield lo, len(length)
