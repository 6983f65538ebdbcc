"""ECMAScript patterns (no flag but g) for Java: one pass over the pattern, one piece of Java for each piece of it.

Groups are counted and all become numbered ones, so names may be any. What the two dialects share in writing but not
in meaning is written out: ``$`` is the very end, ``.`` leaves out four line ends, ``\\w`` and ``\\b`` know ASCII only
and ``\\s`` Unicode's spaces, an empty class matches nothing, a letter without a meaning after a backslash is itself
(``\\p``, ``\\A``, ``\\Q`` too), a brace that is no quantifier is a brace. Surrogate halves are not told apart:
a character beyond the basic plane is one. A lookbehind must have a greatest length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

SPACES = r"\x{9}-\x{d}\x{20}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
WORD = "0-9A-Z_a-z"
SETS = {"d": "0-9", "w": WORD, "s": SPACES}
ANY = r"[\x{0}-\x{10ffff}]"
DOT = r"[^\x{a}\x{d}\x{2028}\x{2029}]"
EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
NO_EDGE = f"(?:(?<=[{WORD}])(?=[{WORD}])|(?<![{WORD}])(?![{WORD}]))"
CONTROLS = {"f": 12, "n": 10, "r": 13, "t": 9, "v": 11}
QUANTIFIER = re.compile(r"[*+?]|\{(\d+)(?:,(\d*))?\}")


class PatternError(ValueError):
    """The pattern or replacement has no counterpart."""


def _char(code: int) -> str:
    c = chr(code)
    return c if c.isascii() and c.isalnum() else f"\\x{{{code:x}}}"


@dataclass
class Pattern:
    """A translated pattern: its Java text, how many groups it has, and the numbers of named ones."""

    source: str
    java: str = ""
    groups: int = 0
    names: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self._count()
        self._at, self._opened, self._closed = 0, 0, set()
        self.java = self._alternatives()
        if self._at < len(self.source):
            raise PatternError(f"unmatched ) in {self.source!r}")

    def _count(self) -> None:
        """Groups and their names, which may be referred to before they come."""
        inside, i = False, 0
        while i < len(self.source):
            c = self.source[i]
            if c == "\\":
                i += 1
            elif inside:
                inside = c != "]"
            elif c == "[":
                inside = True
            elif c == "(":
                name = re.match(r"\(\?<([^=!>][^>]*)>", self.source[i:])
                if name or self.source[i + 1 : i + 2] != "?":
                    self.groups += 1
                if name:
                    if name[1] in self.names:
                        raise PatternError(f"two groups are named {name[1]}")
                    self.names[name[1]] = self.groups
            i += 1

    def _take(self, text: str) -> bool:
        if self.source.startswith(text, self._at):
            self._at += len(text)
            return True
        return False

    def _alternatives(self) -> str:
        out = [self._sequence()]
        while self._take("|"):
            out.append(self._sequence())
        return "|".join(out)

    def _sequence(self) -> str:
        out = []
        while self._at < len(self.source) and self.source[self._at] not in "|)":
            out.append(self._quantified())
        return "".join(out)

    def _quantified(self) -> str:
        if QUANTIFIER.match(self.source, self._at):
            raise PatternError(f"nothing to repeat in {self.source!r}")
        piece, repeats = self._piece()
        m = QUANTIFIER.match(self.source, self._at)
        if not m:
            return piece
        self._at = m.end()
        if not repeats:
            raise PatternError(f"nothing to repeat in {self.source!r}")
        if m[2] and int(m[2]) < int(m[1]):
            raise PatternError(f"a range out of order in {self.source!r}")
        return f"(?:{piece}){m[0]}" + "?" * self._take("?")

    def _piece(self) -> tuple[str, bool]:
        """Java for what comes next, and whether it may be repeated."""
        c = self.source[self._at]
        if c == "(":
            return self._group()
        self._at += 1
        if c == "[":
            return self._class(), True
        if c == "\\":
            return self._escape()
        fixed = {"^": (r"\A", False), "$": (r"\z", False), ".": (DOT, True)}
        return fixed.get(c, (_char(ord(c)), True))

    def _group(self) -> tuple[str, bool]:
        for mark, head, repeats in (("(?:", "(?:", True), ("(?=", "(?=", True), ("(?!", "(?!", True), ("(?<=", "(?<=", False), ("(?<!", "(?<!", False)):
            if self._take(mark):
                return self._closed_with(head), repeats
        self._at += 1
        if self._take("?"):
            name = re.compile(r"<([^>]+)>").match(self.source, self._at)
            if not name:
                raise PatternError(f"an unknown group in {self.source!r}")
            self._at = name.end()
        self._opened += 1
        own = self._opened
        out = self._closed_with("(")
        self._closed.add(own)
        return out, True

    def _closed_with(self, head: str) -> str:
        out = head + self._alternatives() + ")"
        if not self._take(")"):
            raise PatternError(f"a group is not closed in {self.source!r}")
        return out

    def _code(self) -> int | None:
        """The character of an escape that stands for one, in a class and outside; None leaves it to the caller."""
        rest = self.source[self._at :]
        for pattern, base in ((r"x([0-9A-Fa-f]{2})", 16), (r"u([0-9A-Fa-f]{4})", 16), (r"([0-3][0-7]{0,2}|[4-7][0-7]?)", 8)):
            if m := re.match(pattern, rest):
                self._at += m.end()
                code = int(m[1], base)
                if 0xD800 <= code < 0xDC00 and (low := re.match(r"\\u([Dd][C-Fc-f][0-9A-Fa-f]{2})", self.source[self._at :])):
                    self._at += low.end()
                    return 0x10000 + ((code - 0xD800) << 10) + int(low[1], 16) - 0xDC00
                return code
        if m := re.match(r"c([A-Za-z])", rest):
            self._at += 2
            return ord(m[1]) % 32
        if rest[:1] == "c":
            return ord("\\")  # the letter is a character of its own
        self._at += 1
        return CONTROLS.get(rest[0], ord(rest[0]))

    def _escape(self) -> tuple[str, bool]:
        rest = self.source[self._at :]
        if not rest:
            raise PatternError(f"a backslash at the end of {self.source!r}")
        if rest[0] in "bB":
            self._at += 1
            return (EDGE if rest[0] == "b" else NO_EDGE), False
        if rest[0].lower() in SETS:
            self._at += 1
            return f"[{'^' * rest[0].isupper()}{SETS[rest[0].lower()]}]", True
        number = re.match(r"[1-9][0-9]*", rest)
        if number and int(number[0]) <= self.groups:
            self._at += number.end()
            return self._reference(int(number[0])), True
        name = re.match(r"k<([^>]+)>", rest)
        if name and self.names:
            if name[1] not in self.names:
                raise PatternError(f"no group is named {name[1]}")
            self._at += name.end()
            return self._reference(self.names[name[1]]), True
        return _char(self._code()), True

    def _reference(self, n: int) -> str:
        return f"(?:\\{n})" if n in self._closed else "(?:)"  # a group that is still open, or to come, is empty there

    def _class(self) -> str:
        negated, parts, others = self._take("^"), [], []
        while not self._take("]"):
            if self._at >= len(self.source):
                raise PatternError(f"a class is not closed in {self.source!r}")
            low = self._member(others)
            if self.source[self._at : self._at + 1] == "-" and self.source[self._at + 1 : self._at + 2] not in ("]", ""):
                self._at += 1
                high = self._member(others)
                if isinstance(low, int) and isinstance(high, int):
                    if high < low:
                        raise PatternError(f"a range out of order in {self.source!r}")
                    parts.append(f"{_char(low)}-{_char(high)}")
                    continue
                parts += [x if isinstance(x, str) else _char(x) for x in (low, ord("-"), high)]
                continue
            parts.append(low if isinstance(low, str) else _char(low))
        inside = "".join(parts)
        every = [f"[{inside}]"] * bool(inside) + [f"[^{x}]" for x in others]
        if not every:
            return ANY if negated else "(?!)"
        if len(every) == 1 and not others:
            return f"[{'^' * negated}{inside}]"
        return f"(?:(?!{'|'.join(every)}){ANY})" if negated else f"(?:{'|'.join(every)})"

    def _member(self, others: list[str]) -> int | str:
        """A character, or the text of a set; complements of sets go to others."""
        c = self.source[self._at]
        self._at += 1
        if c != "\\":
            return ord(c)
        rest = self.source[self._at :]
        if not rest:
            raise PatternError(f"a class is not closed in {self.source!r}")
        if rest[0].lower() in SETS:
            self._at += 1
            if rest[0].isupper():
                others.append(SETS[rest[0].lower()])
                return ""
            return SETS[rest[0]]
        if rest[0] == "b":
            self._at += 1
            return 8
        return self._code()


def replacement(text: str, pattern: Pattern) -> tuple[str, str]:
    """(Java pattern, Java replacement) of a replacement text: $$, $&, $', $n and $<name>; what names no group stays as it is."""
    java, behind = pattern.java, pattern.groups + 1

    def one(token: str) -> str:
        nonlocal java
        if token in ("\\", "$"):
            return "\\" + token
        if token == "$$":
            return "\\$"
        if token == "$&":
            return "$0"
        if token == "$`":
            raise PatternError("the text before a match ($`) can't be put in")
        if token == "$'":
            java = f"(?:{pattern.java})(?=({ANY}*))"
            return f"${behind}"
        if token[1] == "<":
            if not pattern.names:
                return "\\" + token
            return f"${pattern.names[token[2:-1]]}" if token[2:-1] in pattern.names else ""
        digits = token[1:]
        for n in range(len(digits), 0, -1):
            if 1 <= int(digits[:n]) <= pattern.groups:
                return f"${int(digits[:n])}" + "".join(f"\\{x}" for x in digits[n:])
        return "\\" + token

    # digits that follow a reference are no part of its number
    parts = re.split(r"(\\|\$\$|\$&|\$`|\$'|\$[0-9]{1,2}|\$<[^>]*>|\$)", text)
    out = ""
    for i, part in enumerate(parts):
        if i % 2:
            out += one(part)
        else:
            out += re.sub("^[0-9]", lambda d: f"\\{d[0]}", part) if i else part
    return java, out
