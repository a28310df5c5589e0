"""Token ids of texts with a byte-level BPE file of the tokenizers library.

Byte-level BPE merges inside pre-tokens only, so a text may be cut at any
pre-token boundary and its ids are those of the pieces in a row. Boundaries
used here: before a single space or line feed that follows a non-space and
after a line feed that precedes one; between a letter and one closing mark.
Arrow kernels cut the texts of a batch, number their distinct pieces, and look
them up among those that the worker keeps; only new ones are encoded, many
joined to one string. Pieces and their ids are kept in Arrow arrays, so nothing
is done piece by piece in Python. Texts where the rule does not hold (white
space around white space, a special token's string inside) are encoded whole.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Pieces a worker keeps in two generations (about 60 bytes each): when the young
# one is full it becomes the old one, and pieces met again move to the young.
KEPT_PIECES = 600_000
# New pieces that are encoded in one string.
JOINED = 2_000
# Pieces of letters and at most one closing mark: the letters are one pre-token, the
# mark is another. Letters here are those that no version of Unicode changes.
_LATIN = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORDS = ("^([A-Za-z]+)([.,;:!?]?)$", f"^([{_LATIN}]+)([.,;:!?]?)$")
_TEXT = pa.large_string()
_LISTS = pa.large_list(pa.uint32())


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _lists(ids: list[np.ndarray], sizes: list[np.ndarray]) -> pa.Array:
    """Lists of ``sizes`` ids, in a row."""
    offsets = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))))
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(np.concatenate([np.zeros(0, "<u4"), *ids])))


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives one core to a task
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        # new pieces are all different, so the merges that encode them keep no cache
        bare = BPE(model["vocab"], merges, cache_capacity=0, **{k: model[k] for k in options if model.get(k) is not None})
        self.new = Tokenizer(bare)
        self.new.pre_tokenizer = self.tokenizer.pre_tokenizer
        # the same merges without the byte-level pre-tokenizer: words of letters are
        # one pre-token each, so they can be mapped and cut at their spaces here
        self.letters = Tokenizer(bare)
        self.letters.pre_tokenizer = WhitespaceSplit()
        self.space = _byte_letters()[32]
        # byte 0 stands where a pre-token ends without a space
        self.bytes = {b: c for b, c in _byte_letters().items()} | {32: " " + self.space, 0: " "}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kept = kept
        self.forget()
        self.feed = int(np.frombuffer(self._whole(["\n"])[0], "<u4")[0])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for t, i in vocabulary.items() if t.startswith(self.space)]] = True
        self.fed = np.arange(len(self.spaced)) == self.feed

    def forget(self) -> None:
        """Drop all kept pieces."""
        # pieces as they stand after a space, or at a line's start ("\n" first), and their ids
        self.pieces, self.ids = pa.array([], _TEXT), pa.array([], _LISTS)
        self.old, self.old_ids = self.pieces, self.ids

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _mapped(self, joined: str) -> str:
        """Words of letters, each after a space, in the letters of the vocabulary."""
        if joined.isascii():
            return joined.replace(" ", " " + self.space).replace("\0", " ")
        return joined.encode().decode("latin1").translate(self.bytes)

    def _joined(self, pieces: pa.Array, before: str, tokenizer, heads: np.ndarray, text_of=str) -> pa.Array:
        """Ids of pieces that stand after ``before``. All in a row they are one text
        in which exactly the first id of each piece is one of ``heads``."""
        ids, sizes = [], []
        bounds = pa.array(np.append(np.arange(0, len(pieces), JOINED), len(pieces)), pa.int64())
        for part in pc.binary_join(pa.LargeListArray.from_arrays(bounds, pieces), pa.scalar(before, _TEXT)).to_pylist():
            found = tokenizer.encode_batch_fast([text_of(before + part)], add_special_tokens=False)[0]
            ids.append(np.array(found.ids, "<u4"))
            sizes.append(np.diff(np.append(np.flatnonzero(heads[ids[-1]]), len(ids[-1]))))
        if sum(map(len, sizes)) != len(pieces):
            raise ValueError("the vocabulary's pre-tokens do not begin at spaces and line feeds")
        return _lists(ids, sizes)

    def _learn(self, new: pa.Array) -> pa.Array:
        """Ids of new pieces. No piece is empty or holds white space, but the line
        feed that some begin with."""
        rest, order, found = np.arange(len(new)), [], []

        def take(chosen: pa.Array) -> pa.Array:
            nonlocal rest
            chosen = chosen.to_numpy(zero_copy_only=False)
            order.append(rest[chosen])
            rest = rest[~chosen]
            return new.take(pa.array(order[-1]))

        firsts = take(pc.starts_with(new, "\n"))
        found.append(self._joined(pc.utf8_slice_codeunits(firsts, 1), "\n", self.new, self.fed))
        for pattern in _WORDS:
            words = take(pc.match_substring_regex(new.take(pa.array(rest)), pattern))
            apart = pc.replace_substring_regex(words, "([.,;:!?])$", "\0\\1")
            found.append(self._joined(apart, " ", self.letters, self.spaced, self._mapped))
        order.append(rest)
        found.append(self._joined(new.take(pa.array(rest)), " ", self.new, self.spaced))
        return pa.concat_arrays(found).take(pa.array(np.argsort(np.concatenate(order))))

    def _places(self, pieces: pa.Array) -> pa.Array:
        """The place of each of these different pieces among the kept, new ones
        learnt and old ones moved there."""
        if len(self.pieces) > self.kept // 2:
            old, old_ids = self.pieces, self.ids
            self.forget()
            self.old, self.old_ids = old, old_ids
        place = pc.index_in(pieces, value_set=self.pieces)
        absent = pc.is_null(place).to_numpy(zero_copy_only=False)
        missing = pieces.filter(pa.array(absent))
        again = pc.index_in(missing, value_set=self.old)
        new = pc.is_null(again)
        learnt = missing.filter(new)
        # the old ones stand first, then the new ones
        order = np.argsort(new.to_numpy(zero_copy_only=False), kind="stable")
        place = place.fill_null(0).to_numpy().astype(np.int64)
        place[np.flatnonzero(absent)[order]] = len(self.pieces) + np.arange(len(missing))
        self.pieces = pa.concat_arrays([self.pieces, missing.filter(pc.invert(new)), learnt])
        self.ids = pa.concat_arrays([self.ids, self.old_ids.take(again.drop_null()), self._learn(learnt)])
        return pa.array(place)

    def _splits(self, texts: pa.Array) -> np.ndarray:
        """Whether single spaces and line feeds are a text's only white space
        (other white space is not printable) and none stands at an edge."""
        ok = pc.utf8_is_printable(pc.replace_substring(texts, "\n", ""))
        for s in ("  ", " \n", "\n ", "\n\n", *self.special):
            ok = pc.and_not(ok, pc.match_substring(texts, s))
        for s in (" ", "\n"):
            ok = pc.and_not(pc.and_not(ok, pc.starts_with(texts, s)), pc.ends_with(texts, s))
        return pc.and_(ok, pc.greater(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text; null is empty."""
        texts = pc.fill_null(texts.cast(_TEXT), "")
        splits = self._splits(texts)
        ids, sizes = self._encode_pieces(texts.filter(pa.array(splits)))
        if splits.all():
            return ids, sizes
        ends = np.cumsum(sizes)
        cut = iter([ids[b - n : b] for n, b in zip(sizes, ends)])
        whole = iter([np.frombuffer(x, "<u4") for x in self._whole(texts.filter(pa.array(~splits)).to_pylist())])
        parts = [next(cut) if s else next(whole) for s in splits]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _encode_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        lines = pc.binary_join_element_wise(pa.scalar("\n", _TEXT), pc.replace_substring(texts, "\n", " \n"), pa.scalar("", _TEXT))
        cut = pc.split_pattern(lines, " ")
        coded = pc.dictionary_encode(cut.flatten())
        place = self._places(coded.dictionary)
        found = self.ids.take(place.take(coded.indices))
        bounds = found.offsets.to_numpy()[cut.offsets.to_numpy()]
        # each text begins with the line feed put before its first piece
        sizes = np.diff(bounds)
        ids = found.flatten().to_numpy()
        keep = np.ones(len(ids), bool)
        keep[bounds[:-1] - bounds[0]] = False
        return ids[keep], sizes - 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, kept: int = KEPT_PIECES) -> Encoder:
    """The worker's encoder of a vocabulary file, keeping ``kept`` pieces."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    found = _ENCODERS[path]
    if kept < found.kept:  # a worker may come from a query that kept more
        found.forget()
    found.kept = kept
    return found
