"""The listings of a JSON envelope, read from a stream in bounded pieces."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import TextIO

PIECE = 1 << 16
#: Characters of the longest value that is still taken for a listing.
MOST = 1 << 26
_BLANK = " \t\r\n"
# Where a text that breaks off is found faulty: its last literal, number or escape sequence.
_MARGIN = 16
_BRACKETS = re.compile(r'["\[\]{}]')
_STRING_END = re.compile(r'["\\]')


class _Cursor:
    """Values of a JSON text one after another; holds one value and a piece of text at a time."""

    def __init__(self, stream: TextIO, most: int = MOST) -> None:
        self._stream = stream
        self._most = most
        self._text = ""
        self._at = 0
        self._decode = json.JSONDecoder().raw_decode

    def _more(self) -> bool:
        # As much again as is held: what a long value costs grows with its length only.
        piece = self._stream.read(max(PIECE, len(self._text) - self._at))
        self._text, self._at = self._text[self._at :] + piece, 0
        return bool(piece)

    def peek(self) -> str:
        """The next sign that isn't blank; empty at the end."""
        while True:
            while self._at < len(self._text):
                if self._text[self._at] not in _BLANK:
                    return self._text[self._at]
                self._at += 1
            if not self._more():
                return ""

    def take(self, signs: str) -> str:
        found = self.peek()
        if not found or found not in signs:
            raise ValueError(f"malformed listing document: {found or 'end'!r} where one of {signs!r} belongs")
        self._at += 1
        return found

    def value(self) -> str:
        """The text of the next value. A fault in it is an error as soon as it is read."""
        self.peek()
        while True:
            try:
                _, end = self._decode(self._text, self._at)
                # A number may go on in the next piece.
                if end < len(self._text) or not self._more():
                    found, self._at = self._text[self._at : end], end
                    return found
            except json.JSONDecodeError as error:
                breaks_off = error.pos >= len(self._text) - _MARGIN or error.msg.startswith("Unterminated string")
                if not breaks_off or not self._more():
                    raise ValueError(f"malformed listing document: {error.msg}") from None
            if len(self._text) - self._at > self._most:
                raise ValueError(f"malformed listing document: a value of over {self._most} characters")

    def skip(self) -> None:
        """Pass over the next value, holding none of an array or object."""
        if self.peek() not in ("[", "{"):
            self.value()
            return
        inside: list[str] = []
        while True:
            found = _BRACKETS.search(self._text, self._at)
            if found is None:
                self._at = len(self._text)
                if not self._more():
                    raise ValueError("malformed listing document: it breaks off within a value")
                continue
            self._at = found.end()
            sign = found.group()
            if sign == '"':
                self._skip_string()
            elif sign in "[{":
                inside.append("]" if sign == "[" else "}")
            elif sign != inside.pop():
                raise ValueError(f"malformed listing document: {sign!r} closes another bracket")
            if not inside:
                return

    def _skip_string(self) -> None:
        while True:
            found = _STRING_END.search(self._text, self._at)
            if found is None or found.end() == len(self._text) and found.group() == "\\":
                self._at = len(self._text) if found is None else found.start()
                if not self._more():
                    raise ValueError("malformed listing document: it breaks off within a string")
                continue
            self._at = found.end()
            if found.group() == '"':
                return
            self._at += 1


def listings(stream: TextIO, key: str = "data", most: int = MOST) -> Iterator[str]:
    """The text of each element of the array ``key`` of the document's object.

    A document that is broken, cut off, has no such array or a value of over ``most`` characters is an
    error. Other arrays and objects are passed over; of these, only brackets and strings are checked.
    """
    cursor, found = _Cursor(stream, most), False
    cursor.take("{")
    while cursor.peek() != "}":
        name = json.loads(cursor.value())
        cursor.take(":")
        if name == key and cursor.peek() == "[":
            found = True
            cursor.take("[")
            while cursor.peek() != "]":
                yield cursor.value()
                if cursor.peek() != "]":
                    cursor.take(",")
            cursor.take("]")
        else:
            cursor.skip()
        if cursor.peek() != "}":
            cursor.take(",")
    cursor.take("}")
    if cursor.peek():
        raise ValueError("malformed listing document: it goes on after its end")
    if not found:
        raise ValueError(f"malformed listing document: no array {key!r}")
