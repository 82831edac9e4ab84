"""Token ids of whole texts, by a public tokenizer that drops white space.

The tokenizers meant here lower-case a text, split it into runs of letters,
single digits and runs of other characters, never across white space, and
encode each run by itself (byte-level BPE with word ends).  So a text's ids are
those of its blank-separated pieces in a row.

A block of texts is split into pieces, its distinct pieces into runs, and each
distinct run is encoded once; the ids are then put together by index.  Splitting
is done by Arrow, encoding by the tokenizer's model, in one call for all runs.
Only pieces of Latin-1 characters go this way; other pieces go through the
whole tokenizer, each distinct one once.  A bounded number of pieces is kept
from block to block, so the work space follows the block's bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-tokenizer's rule for lower-case Latin-1 (and the line end between
#: pieces), and byte-level BPE's character of each byte (printable bytes stand for
#: themselves, the others follow from 256 on).
_RUNS = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\na-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_REST = [b for b in range(0x100) if b not in _PRINTABLE]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(0x100 + i) for i, b in enumerate(_REST)}
#: The characters of the bytes of each Latin-1 character beyond ASCII.
_LATIN = {chr(c): "".join(map(_BYTE_CHARS.__getitem__, chr(c).encode())) for c in range(0xA1, 0x100)}
_BEYOND_ASCII = re.compile("[^\x00-\x7F]")
#: Pieces whose case and classes are beyond doubt: Latin-1 without controls, blanks and the soft hyphen.
_SIMPLE = r"^[\x21-\x7E\x{A1}-\x{AC}\x{AE}-\x{FF}]+$"
#: Pieces kept from block to block.
KEPT_PIECES = 300_000
#: Runs and pieces handed to the tokenizer in one call.
_RUNS_A_CALL, _PIECES_A_CALL = 65536, 4096

_encoders: dict = {}


def _gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``flat[first:first + size]``, one after the other."""
    ends = np.cumsum(size, dtype=np.int32)
    where = np.repeat(first - (ends - size), size)
    where += np.arange(len(where), dtype=np.int32)
    return flat[where]


def _firsts(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size, dtype=np.int32) - size


def _joined(strings: pa.Array, between: str) -> str:
    one = pa.ListArray.from_arrays(pa.array([0, len(strings)], pa.int32()), strings)
    return pc.binary_join(one, between)[0].as_py()


class BlockEncoder:
    """Ids (unsigned 16-bit) of blocks of texts.  For tokenizers of at most 65,536 ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tok.get_vocab()
        self.suffix = self.tok.model.end_of_word_suffix
        if len(vocabulary) > 1 << 16 or not self.suffix:
            raise ValueError("more than 65,536 ids, or ids that do not show the end of a word")
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(self.suffix)]] = True
        # the same model for runs of byte characters, with blanks between them
        self.by_run = Tokenizer(self.tok.model)
        self.by_run.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        self._forget()

    def _forget(self) -> None:
        self.pieces = pa.array([], pa.string())
        self.ids, self.size = np.empty(0, np.uint16), np.empty(0, np.int32)
        self.met_again = np.empty(0, bool)

    def _keep_some(self) -> None:
        """Pieces met in one block only make room, if there are too many."""
        if len(self.pieces) <= KEPT_PIECES:
            return
        again = self.met_again
        if not 0 < again.sum() <= KEPT_PIECES:
            self._forget()
            return
        self.ids = _gather(self.ids, _firsts(self.size)[again], self.size[again])
        self.pieces, self.size = self.pieces.filter(pa.array(again)), self.size[again]
        self.met_again = np.zeros(len(self.size), bool)

    def _runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs in a row, and how many each has."""
        found = [np.empty(0, np.uint16)]
        for at in range(0, len(runs), _RUNS_A_CALL):
            text = _BEYOND_ASCII.sub(lambda m: _LATIN[m[0]], _joined(runs.slice(at, _RUNS_A_CALL), " "))
            found.append(np.array(self.by_run.encode_batch_fast([text], add_special_tokens=False)[0].ids,
                                  np.uint16))
        ids = np.concatenate(found)
        size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).astype(np.int32)
        if len(size) != len(runs):
            raise ValueError("the tokenizer does not encode each run by itself")
        return ids, size

    def _simple(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = pa.array(_RUNS.findall(_joined(pc.utf8_lower(pieces), "\n")), pa.string())
        is_run = pc.not_equal(flat, "\n").to_numpy(zero_copy_only=False)
        runs = flat.filter(pa.array(is_run)).dictionary_encode()
        ids, size = self._runs(runs.dictionary)
        which = runs.indices.to_numpy()
        n_ids = size[which]
        total = np.zeros(len(flat) + 1, np.int32)
        total[1:][is_run] = n_ids
        total = np.cumsum(total, dtype=np.int32)
        ends = np.append(np.flatnonzero(~is_run), len(flat))[:len(pieces)]
        return _gather(ids, _firsts(size)[which], n_ids), np.diff(total[ends], prepend=np.int32(0))

    def _others(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.empty(0, np.uint16)]
        size = []
        for at in range(0, len(pieces), _PIECES_A_CALL):
            for c in self.tok.encode_batch_fast(pieces.slice(at, _PIECES_A_CALL).to_pylist(),
                                                add_special_tokens=False):
                found.append(np.array(c.ids, np.uint16))
                size.append(len(found[-1]))
        return np.concatenate(found), np.array(size, np.int32)

    def _learn(self, fresh: pa.Array) -> np.ndarray:
        """Adds pieces; returns their places."""
        simple = pc.match_substring_regex(fresh, _SIMPLE)
        others = pc.invert(simple)
        before = len(self.pieces)
        for some, how in ((simple, self._simple), (others, self._others)):
            pieces = fresh.filter(some)
            ids, size = how(pieces)
            self.pieces = pa.concat_arrays([self.pieces, pieces])
            self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
        self.met_again = np.concatenate([self.met_again, np.zeros(len(fresh), bool)])
        order = np.argsort(others.to_numpy(zero_copy_only=False), kind="stable")
        places = np.empty(len(fresh), np.int32)
        places[order] = np.arange(before, before + len(fresh), dtype=np.int32)
        return places

    def encode(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (null: empty; with the id ``end`` after each
        if given), and where each text begins and the last one ends."""
        split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        words = split.flatten().dictionary_encode()
        known = pc.index_in(words.dictionary, value_set=self.pieces)
        place = pc.fill_null(known, -1).to_numpy().copy()
        new = place < 0
        self.met_again[place[~new]] = True
        if new.any():
            place[new] = self._learn(words.dictionary.filter(pa.array(new)))
        which = place[words.indices.to_numpy()]
        n_ids = self.size[which]
        flat = _gather(self.ids, _firsts(self.size)[which], n_ids)
        total = np.concatenate([np.zeros(1, np.int32), np.cumsum(n_ids, dtype=np.int32)])
        bounds = total[split.offsets.to_numpy()]
        if end is not None:
            flat = np.insert(flat, bounds[1:], end)
            bounds = bounds + np.arange(len(bounds), dtype=np.int32)
        self._keep_some()
        return flat, bounds


def encoder(path: str) -> BlockEncoder:
    """The encoder of a tokenizer file, loaded once per Python process."""
    if path not in _encoders:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _encoders[path] = BlockEncoder(path)
    return _encoders[path]
