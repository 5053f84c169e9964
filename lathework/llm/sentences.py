"""Sentences and lines of texts in several scripts."""

from __future__ import annotations

import re

import regex

# A stop ends a sentence before a blank or the end, and so does a line break that isn't a mere wrap. The danda needs no blank.
_CUT = regex.compile(r"(?<=[.!?。！？．…][\"”»'’*_)\]]{0,3})\s+|(?<=[।॥])\s*|\s*[\r\n]+\s*")
_STOP = re.compile(r"([.!?。！？．…][\"”»'’*_)\]]{0,3})\s+")  # the same where neither a danda nor a line break occurs
_LINES = re.compile(r"[\r\n।॥]")
_HEADING = regex.compile(r"(?m)^([ \t]*#+[ \t].*)$")
_WRAP = regex.compile(r"(?<=[^\s.!?।॥。！？．…:>|*_}\]\"”»])[ \t]*\r?\n[ \t]*(?!\s*(?:[-*•>#<|]|\d+[.)]\s|\p{L}{1,15}\s?:|[\r\n]|$))")
_BULLET = regex.compile(r"^\s*(?:[-*•>]+\s+|\d+[.)]\s+)")
STOPS = ".!?।॥。！？．"


def sentences(text: str | None) -> list[str]:
    """Non-blank sentences, bullets taken off.

    A line break ends a sentence unless the line before has no stop and what follows is neither a list item, a heading, a
    name with a colon, nor an empty line: then the text was merely wrapped.
    """
    text = text or ""
    if "\n" in text:
        text = _WRAP.sub(" ", _HEADING.sub("\\1\n\n", text))
    out = []
    if _LINES.search(text):
        parts = _CUT.split(text)
    else:  # from a stop on, instead of looking back from every blank
        parts, at = [], 0
        for m in _STOP.finditer(text):
            parts.append(text[at : m.end(1)])
            at = m.end()
        parts.append(text[at:])
    for s in parts:
        if s and (s := _BULLET.sub("", s).strip()):
            out.append(s)
    return out
