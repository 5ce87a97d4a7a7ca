"""Token ids of whole texts, through the pieces between white space.

A tokenizer never joins two words across white space, so a text's ids are those of its pieces put
together. Each new piece is encoded once by the tokenizers library: pieces of letters and
marks, which its splitting rules leave whole, by the library's model alone, all others by the whole
tokenizer. Texts whose white space could matter (runs, other blanks than space and newline, special
tokens) are encoded whole.

`encode` takes text after text and keeps the pieces it met. `bulk` takes the texts in groups of some
characters: the distinct letters and marks of a group that are not known yet are encoded in a few calls, kept
as arrays (some 30 bytes a word), and put together as arrays.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trailsight.llm.common import free

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that are kept at most, some 200 bytes each: half of them new, half those that were kept before.
PIECES = 400_000
#: Characters of a group of texts that are encoded together, about; a longer text is encoded by itself.
GROUP = 2_000_000
#: Distinct words that one call of the library encodes, and that are kept after a group; of more, only its own are.
WORDS, KEPT = 1000, 250_000
#: White space other than space and newline.
_ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_SEPARATORS = re.compile("[\x1c-\x1f]")
#: Letters, of which one splitting rule takes all, then marks, of which another does.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")
_PARTS = r"\A(?P<lead>[\r\n]?)(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)\z"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in seen else next(rest)) for b in range(256)]


def runs(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of runs of n from each start on, one run after the other."""
    end = np.cumsum(n)
    kind = np.int32 if not len(n) or max(end[-1], start.max()) < 1 << 31 else np.int64
    places = np.repeat((start - end + n).astype(kind), n)
    places += np.arange(len(places), dtype=kind)
    return places


class Encoder(dict):
    """Piece -> its ids as bytes; `before` holds the pieces that the last full round kept. `white_space` says whether the tokenizer keeps it in its ids (byte level) or drops it."""

    def __init__(self, path: str, white_space: bool) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.keeps = white_space
        self.type = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        letter = byte_letters()
        self.wide = {c: letter[chr(c).encode()[0]] + letter[chr(c).encode()[1]] for c in range(0xC0, 0x100)}
        self.blank, self.newline = letter[32], letter[10]
        # The model alone, for words set apart by the letter of byte 0; and how many bytes each id stands for.
        self.letters = "".join(letter)
        self.words = Tokenizer(self.model)
        self.words.pre_tokenizer = Split(letter[0], "removed")
        self.bytes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int32)
        suffix = self.model.end_of_word_suffix or ""
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = len(token.removesuffix(suffix))
        self.forget()
        free()

    def ready(self, text: str) -> str | None:
        """A text whose white space parts its pieces, or None if it has to be encoded whole. Kept white space
        leads its piece, after a blank: a newline as it is, a blank left out, and a carriage return for none at all."""
        if "<|" in text:
            return None
        if not self.keeps:
            return None if _SEPARATORS.search(text) else text
        if text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ("  ", "\n\n", " \n", "\n ")) or _ODD_SPACE.search(text):
            return None
        return ("\r" + text).replace("\n", " \n")

    def pieces(self, text: str) -> list[str] | None:
        """Pieces of a text, or None if it has to be encoded whole."""
        text = self.ready(text)
        return None if text is None else text.split(" ") if self.keeps else text.split()

    def forget(self) -> None:
        self.clear()
        self.before = {}
        self.known = pa.array([], pa.string()), np.zeros(0, dtype=self.type), np.zeros(0, dtype=np.int32)

    def age(self) -> None:
        if len(self) > PIECES // 2:
            self.before = dict(self)
            self.clear()

    def __missing__(self, piece: str) -> bytes:
        known = self.before.get(piece)
        if known is not None:
            self[piece] = known
            return known
        lead, body = (piece[0], piece[1:]) if self.keeps and piece[0] in "\r\n" else (" ", piece)
        plain = _PLAIN.fullmatch(body)
        if plain:
            letters, marks = plain.groups()
            if not self.keeps:
                letters = letters.lower()
            if not letters.isascii():
                letters = letters.translate(self.wide)
            if self.keeps and lead == " ":
                letters = self.blank + letters
            found = self.model.tokenize(letters)
            if marks:
                found += self.model.tokenize(marks)
            if lead == "\n":
                found = self.model.tokenize(self.newline) + found
            ids = [t.id for t in found]
        else:
            whole = piece if not self.keeps else body if lead == "\r" else lead + body
            ids = self.tokenizer.encode(whole, add_special_tokens=False).ids
        out = self[piece] = array("H" if self.type is np.uint16 else "I", ids).tobytes()
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text; none for null and empty ones."""
        find = self.__getitem__
        for text in texts:
            pieces = self.pieces(text) if text else []
            if pieces is None:
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.type)
                continue
            yield np.frombuffer(b"".join(map(find, pieces)), dtype=self.type)
            self.age()


    def word_ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that no splitting rule divides, one after the other, and how many each has."""
        if not len(words):
            return np.zeros(0, dtype=self.type), np.zeros(0, dtype=np.int32)
        some = pa.ListArray.from_arrays(pa.array([*range(0, len(words), WORDS), len(words)], pa.int32()), words)
        calls = (charmap_decode(joined.as_buffer(), "strict", self.letters)[0] for joined in pc.binary_join(some, "\0"))
        ids = [np.array(self.words.encode_batch_fast([call], add_special_tokens=False)[0].ids, dtype=self.type) for call in calls]
        ids = np.concatenate([np.zeros(0, dtype=self.type), *ids])
        # A word ends where the bytes of its ids have come to its own.
        stops = np.cumsum(pc.binary_length(words).to_numpy(), dtype=np.int64)
        ends = np.searchsorted(np.cumsum(self.bytes[ids], dtype=np.int64), stops, side="right")
        return ids, np.diff(ends, prepend=0).astype(np.int32)

    def look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where in them those of each of some distinct words start and how many they are."""
        known, ids, n = self.known
        at = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().copy()
        new = np.flatnonzero(at < 0)
        at[new] = len(known) + np.arange(len(new))
        new = words.take(pa.array(new))
        new_ids, new_n = self.word_ids(new)
        known, ids, n = pa.concat_arrays([known, new]), np.concatenate([ids, new_ids]), np.concatenate([n, new_n])
        start = (np.cumsum(n) - n).astype(np.int32)
        if len(known) > KEPT:
            known, ids, n = words, ids.take(runs(start[at], n[at])), n[at]
            start, at = (np.cumsum(n) - n).astype(np.int32), slice(None)
        self.known = known, ids, n
        return ids, start[at], n[at]

    def group(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each of some texts that are ready."""
        texts = pa.array(texts, pa.string())
        split = pc.split_pattern(texts, " ") if self.keeps else pc.utf8_split_whitespace(texts)
        stops, found = split.offsets.to_numpy()[1:], split.values.dictionary_encode()
        pieces, kind = found.dictionary, found.indices.to_numpy()
        parts = pc.extract_regex(pieces, _PARTS)
        odd = np.flatnonzero(parts.is_null().to_numpy(zero_copy_only=False))
        lead, letters, marks = (pc.fill_null(pc.struct_field(parts, c), "") for c in ("lead", "letters", "marks"))
        if self.keeps:
            blank = pc.if_else(pc.and_(pc.equal(lead, ""), pc.not_equal(letters, "")), " ", "")
            letters = pc.binary_join_element_wise(blank, letters, "")
        else:
            letters = pc.utf8_lower(letters)
        # A piece is three runs of ids: a newline, letters (or all of an odd piece) and marks.
        words = pa.concat_arrays([pc.if_else(pc.equal(lead, "\n"), "\n", ""), letters, marks]).dictionary_encode()
        ids, start, n = self.look_up(words.dictionary)
        which = words.indices.to_numpy().reshape(3, -1).T
        start, n = start[which], n[which]
        del split, found, texts, parts, lead, letters, marks, words, which
        more = []
        for i in odd:
            more.append(np.frombuffer(self[pieces[i].as_py()], dtype=self.type))
            self.age()
        n[odd, 1] = [len(x) for x in more]
        start[odd, 1] = len(ids) + np.cumsum(n[odd, 1]) - n[odd, 1]
        ids = np.concatenate([ids, *more]).take(runs(start.ravel(), n.ravel()))
        n = n.sum(axis=1, dtype=np.int32)
        start = (np.cumsum(n) - n).astype(np.int32)
        for first, stop in zip(np.append(0, stops[:-1]).tolist(), stops.tolist(), strict=True):
            of = kind[first:stop]
            yield ids.take(runs(start.take(of), n.take(of)))

    def bulk(self, texts: Iterable[str | None], group: int = GROUP) -> Iterator[np.ndarray]:
        """As `encode`, some texts of `group` characters in all at a time; larger groups take less time, but more memory."""
        held: list[str | np.ndarray] = []
        chars = 0

        def flush() -> Iterator[np.ndarray]:
            ready = [x for x in held if isinstance(x, str)]
            got = self.group(ready) if ready else iter(())
            yield from (next(got) if isinstance(x, str) else x for x in held)
            free()

        for text in texts:
            ready = self.ready(text) if text and len(text) <= group else None
            held.append(next(self.encode([text])) if ready is None else ready)
            chars += len(ready or "")
            if chars >= group:
                yield from flush()
                held, chars = [], 0
        yield from flush()


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, white_space: bool) -> Encoder:
    """One for each worker process, kept between tasks, with its pieces if the task does not have it forget them."""
    if (path, white_space) not in _encoders:
        _encoders[path, white_space] = Encoder(path, white_space)
    return _encoders[path, white_space]
