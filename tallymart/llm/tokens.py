"""Token ids of whole texts, with the tokenizer called once per distinct piece."""

from __future__ import annotations

import os
from array import array

PIECES = 1_000_000  # pieces a worker remembers before it begins anew; only speed depends on it
END_ID = 1
MARKS = ".,;:!?"


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(text: str) -> list[str]:
    """Cuts `text` where a byte-level BPE of this kind always cuts.

    Its pattern begins a new piece at a single space between two characters
    that are not white space, so the parts can be encoded one by one. Around
    any other white space nothing is cut.
    """
    parts = text.split(" ")
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        if part and last and not part[0].isspace() and not last[-1].isspace():
            out.append(" " + part)
        else:
            out[-1] = f"{last} {part}"
    return out


def bare(piece: str) -> str:
    """The piece without the marks at its end: after a letter they are always a piece of
    their own."""
    word = piece.rstrip(MARKS)
    return word if word[-1:].isalpha() else piece


def _byte_marks() -> list[str]:
    """The sign a byte-level BPE writes for each byte: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_SIGNS = _byte_marks()
LETTERS_END = "\u0250"  # behind Latin letters; from here on the whole tokenizer is asked
_LATIN = {c: "".join(_SIGNS[b] for b in chr(c).encode()) for c in range(0x80, ord(LETTERS_END))}


def signs(word: str) -> str:
    """A word of Latin letters, with or without the space before it, as the model writes its
    bytes; '' for any other. The pattern never cuts inside such a word."""
    space = word[:1] == " "
    letters = word[1:] if space else word
    if not letters.isalpha():
        return ""
    if not letters.isascii():
        if max(letters) >= LETTERS_END:
            return ""
        letters = letters.translate(_LATIN)
    return _SIGNS[32] + letters if space else letters


class _Numbers(dict):
    """Numbers pieces as they come, from a list that it shares with others."""

    def __init__(self, mark: str, met: list[str]):
        super().__init__()
        self.mark, self.met = mark, met

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self.met)
        self.met.append(self.mark + word)
        return number


class Ids:
    """Text to the bytes of its ids (`width` bytes each, little-endian)."""

    _loaded: dict[str, Ids] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        # The file's own special tokens are found in texts, as `encode` finds them.
        self.model = Tokenizer.from_file(path)
        self.width = 2 if self.model.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        # Words that the tokenizer neither rewrites nor finds among its added tokens go
        # straight to its BPE model, which spares its pattern and the rest of an encoding.
        added = self.model.get_added_tokens_decoder().values()
        as_is = self.model.normalizer is None and not any(t.content.strip().isalpha() for t in added)
        self.merge = self.model.model.tokenize if as_is else None
        self._forget()

    @classmethod
    def at(cls, path: str) -> Ids:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _forget(self) -> None:
        self.met: list[str] = []
        self.known: list[bytes] = []  # ids of `met`, as far as learnt
        self.marked: dict[str, bytes] = {}  # ids of marks behind a word
        self.first, self.spaced = _Numbers("", self.met), _Numbers(" ", self.met)

    def _numbers(self, text: str) -> list[int]:
        out: list[int] = []
        for line in text.split("\n"):
            words = line.split(" ")
            # Printable: no white space but spaces. No empty word: every space stands alone
            # between two words, and the line break between two lines stands alone as well.
            if "" in words or not line.isprintable():
                return list(map(self.first.__getitem__, pieces(text)))
            out.append(self.first["\n" + words[0] if out else words[0]])
            out.extend(map(self.spaced.__getitem__, words[1:]))
        return out

    def _learn(self) -> None:
        """Words of letters are merged one by one; other new pieces are encoded together."""
        marked, known, merge, kind = self.marked, self.known, self.merge, self.kind
        later: dict[str, list[int]] = {}
        for piece in self.met[len(known):]:
            word = bare(piece)
            if merge and (text := signs(word)):
                marks = piece[len(word):]
                if marks not in marked:
                    marked[marks] = array(kind, self.model.encode(marks, add_special_tokens=False).ids).tobytes()
                known.append(array(kind, [t.id for t in merge(text)]).tobytes() + marked[marks])
            else:
                later.setdefault(piece, []).append(len(known))
                known.append(b"")
        found = self.model.encode_batch_fast(list(later), add_special_tokens=False)
        for places, encoding in zip(later.values(), found, strict=True):
            ids = array(kind, encoding.ids).tobytes()
            for at in places:
                known[at] = ids

    def encode_all(self, texts: list[str]) -> list[bytes]:
        numbers = [self._numbers(t) for t in texts]
        self._learn()
        out = [b"".join(map(self.known.__getitem__, x)) for x in numbers]
        if len(self.met) > PIECES:
            self._forget()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]
