"""Words of a text as a reader compares them: runs of letters and digits, whatever their case, accents, width,
punctuation, spacing, markup, invisible characters or hyphens at line ends."""

from __future__ import annotations

import html
import re
import unicodedata

import regex

_COMMENT = regex.compile(r"<!--.*?-->", regex.S)
_BREAK = regex.compile(r"<br\s*/?>", regex.I)
_INLINE = regex.compile(r"</?(?:a|abbr|b|big|bdi|bdo|cite|code|del|dfn|em|font|i|ins|kbd|mark|q|s|small|span|strike|strong|sub|sup|tt|u|var|wbr)(?:\s[^<>]*)?/?>", regex.I)
_TAG = regex.compile(r"</?[a-zA-Z][^<>]*>|<![^<>]*>")
_LINK = regex.compile(r"(!?)\[([^\[\]]*)\]\((?:[^()\s]|\([^()\s]*\))*(?:\s+\"[^\"]*\")?\)")
_LIGHT = regex.compile(r"\*\*|~~|(?<=\p{L})\*(?=\p{L})")
_INVISIBLE = regex.compile(r"[\p{Cf}\p{Cc}\p{Mn}\p{Me}ᅟᅠㅤﾠ--[\n\r\t\v\f]]", regex.V1)
_HYPHEN = regex.compile(r"(?<=[\p{L}\p{N}])[-‐‑¬][ \t]*(?:\r\n?|\n| | )[\s>|*#]*(?=[\p{L}\p{N}])")
_LINE_END = re.compile("[-‐‑¬][ \t]*[\n\r\u2028\u2029]")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
# the same for texts of ASCII alone, which need no tables
_ASCII_WORD = re.compile(r"[A-Za-z0-9]+")
_ASCII_INVISIBLE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def plain(text: str) -> str:
    """The text without markup, accents, width and invisible characters, in folded case; line ends stay."""
    if "<" in text:
        text = _COMMENT.sub("", text)
        text = _BREAK.sub("\n", text)
        text = _INLINE.sub("", text)
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\2", text)
    if not text.isascii():
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text)).casefold()
        if not text.isascii():
            text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", text))
    else:
        text = _ASCII_INVISIBLE.sub("", text).lower()
    return _LIGHT.sub("", text) if "*" in text or "~" in text else text


def _words(base: str) -> list[str]:
    return (_ASCII_WORD if base.isascii() else _WORD).findall(base)


def readings(text: str) -> list[list[str]]:
    """The words of the text; a second list where a hyphen at a line end may also part two words."""
    base = plain(text)
    joined = _HYPHEN.sub("", base)
    first = _words(joined)
    return [first] if joined == base else [first, _words(base)]


LONGEST_CHAIN = 16


def lattice(text: str) -> tuple[list[str], list[int], list[tuple[int, int, str]]]:
    """The words with every hyphen at a line end parting them; the places of words that such a hyphen ties to the next; and
    (place, number of words, joined word) for every way to join tied words, each hyphen for itself.

    Of a chain of more than LONGEST_CHAIN tied words, runs of up to so many are joined, and the whole chain.
    """
    base = plain(text)
    ties = {m.start(): m.end() for m in _HYPHEN.finditer(base)} if _LINE_END.search(base) else None
    if not ties:
        return _words(base), [], []
    spans = [m.span() for m in _WORD.finditer(base)]
    found = [base[a:b] for a, b in spans]
    tied = [i for i in range(len(spans) - 1) if ties.get(spans[i][1]) == spans[i + 1][0]]
    joined: list[tuple[int, int, str]] = []
    at = 0
    while at < len(tied):
        first, last = tied[at], tied[at]
        while at < len(tied) and tied[at] <= last:
            last = tied[at] + 1
            at += 1
        for a in range(first, last):
            for b in range(a + 1, min(last, a + LONGEST_CHAIN - 1) + 1):
                joined.append((a, b - a + 1, "".join(found[a : b + 1])))
        if last - first >= LONGEST_CHAIN:
            joined.append((first, last - first + 1, "".join(found[first : last + 1])))
    return found, tied, joined


def words(text: str) -> list[str]:
    return readings(text)[0]
