"""Byte-level BPE by pre-tokens: equal pre-tokens have equal ids, so each is merged once.

The tokenizers library cuts a text into pre-tokens before it merges, and merges never cross a cut.
``Vocabulary`` cuts with the same pattern and asks the library only for pre-tokens it has not
seen. Around a character that the two regex engines may class differently the text goes to the
library from the last blank before it to the next one behind it, and texts that hold the string of
an added token go there whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import regex
from tokenizers import Tokenizer

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Characters that a test holds to be cut alike by both engines: blanks, and all others.
BLANK = r"\t\n\r\x20"
MARKS = (
    r"\x21-\x7e¡-Ɂ"
    r"΄-ΊΌΎ-ΡΣ-ԯא-תؠ-ي٠-٩،؛؟ऄ-हा-्०-९ก-ฺเ-๎"
    r"\u200d‐-‧‰-⁞₠-₿←-⏿─-⛿✀-➿\ufe0f"
    r"、-〟ぁ-ゖァ-ヺー一-龥가-힣！-～\U0001f300-\U0001faff"
)
PLAIN = BLANK + MARKS
# Pre-tokens that a worker remembers, and characters cut at a time.
CACHE = 800_000
SLICE = 1 << 19
# The longest piece that a worker remembers; scripts without blanks have long ones.
REMEMBERED = 64

_cut = regex.compile(PATTERN)
_odd = re.compile(rf"[^{PLAIN}]")
_PLAIN_LATIN = bytes(c for c in range(256) if not _odd.match(chr(c)))
_gap = regex.compile(r"(?<=\S)\s")
# A blank behind a plain character begins a pre-token for both engines.
_next_cut = regex.compile(rf"(?<=[{MARKS}])[{BLANK}]")
_last_cut = regex.compile(rf"(?r)(?<=[{MARKS}])[{BLANK}]")


@lru_cache(maxsize=4)
def load(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def is_odd(text: str) -> bool:
    """Whether a character is not plain; texts of Latin-1 are looked at as bytes, which is faster."""
    try:
        return bool(text.encode("latin-1").translate(None, _PLAIN_LATIN))
    except UnicodeEncodeError:
        return _odd.search(text) is not None


def runs(text: str) -> Iterator[tuple[bool, str]]:
    """The text in parts that are cut alike alone; true for those that hold an odd character."""
    start = 0
    while start < len(text):
        odd = _odd.search(text, start)
        if odd is None:
            yield False, text[start:]
            return
        last = _last_cut.search(text, start, odd.start())
        following = _next_cut.search(text, odd.end())
        end = following.start() if following else len(text)
        if last is not None and last.start() > start:
            yield False, text[start : last.start()]
            start = last.start()
        yield True, text[start:end]
        start = end


def slices(text: str) -> Iterator[str]:
    """Parts of ``text`` that are cut alike alone: each begins with white space after a word."""
    start = 0
    while len(text) - start > SLICE:
        gap = _gap.search(text, start + SLICE)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:]


class Vocabulary:
    """What one worker knows of a tokenizer: a value for each piece of text it has met.

    Where white space follows a word there is always a cut, so a text whose white space is
    single blanks and line ends falls into pieces at these, far faster than by the pattern. Other
    texts fall into pre-tokens. ``resolve`` gives the values of pieces not met before.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = load(path)
        self.memory: dict[str, object] = {}
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def resolve(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def value(self, ids: list[int]) -> object:
        """The value of a part that the library takes whole, by its ids."""
        raise NotImplementedError

    def whole(self, parts: list[str]) -> list:
        return [self.value(ids) for ids in self.encode(parts)]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        found = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [x.ids for x in found]

    def values(self, texts: list[str | None]) -> list[list]:
        """For each text the values of its pieces, in order; nothing for null."""
        out: list[list] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        odd: set[str] = set()
        size = 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if any(a in text for a in self.added):
                out[i] = self.whole([text])
                continue
            for is_whole, run in runs(text) if is_odd(text) else [(False, text)]:
                for part in [run] if is_whole else slices(run):
                    if is_whole:
                        odd.add(part)
                    held.append((i, [part] if is_whole else pieces(part)))
                    size += len(part)
                    if size > SLICE:
                        self._fill(out, held, odd)
                        held, odd, size = [], set(), 0
        self._fill(out, held, odd)
        return out

    def _fill(self, out: list[list], held: list[tuple[int, list[str]]], odd: set[str]) -> None:
        found = [list(map(self.memory.get, cut)) for _, cut in held]
        holes = [
            [at for at, value in enumerate(got) if value is None] if None in got else ()
            for got in found
        ]
        names = {cut[at] for (_, cut), own in zip(held, holes) for at in own}
        if names:
            fresh: dict[str, object] = {}
            for some, values in ((names - odd, self.resolve), (names & odd, self.whole)):
                listed = list(some)
                if listed:
                    fresh.update(zip(listed, values(listed)))
            for (_, cut), got, own in zip(held, found, holes):
                for at in own:
                    got[at] = fresh[cut[at]]
            short = {name: value for name, value in fresh.items() if len(name) <= REMEMBERED}
            if len(self.memory) + len(short) > CACHE:
                self.memory = {}
            self.memory.update(short)
        for (i, _), got in zip(held, found):
            out[i].extend(got)


def pieces(part: str) -> list[str]:
    """Parts of a plain text between which there is always a cut."""
    if (
        any(x in part for x in ("  ", "\n\n", " \n", "\n "))
        or part[0].isspace()
        or part[-1].isspace()
        or "\t" in part
        or "\r" in part
    ):
        return _cut.findall(part)
    # a blank or line end goes with the word behind it
    return part.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
