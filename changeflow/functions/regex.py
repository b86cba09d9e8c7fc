"""Regular expressions of the linear-time dialect as Java patterns.

Rules are written in the dialect of RE2; Spark's functions read Java's. ``pattern`` rewrites what the two
read differently and refuses what only Java knows, ``replacement`` rewrites the template.

Where the two differ in replacing: the dialect takes the preferred match at each place, passes over an empty
one right after another match, and goes on a character later; Java takes it. Patterns that can match nothing
are therefore atomic, and their match must not end where the last one ended (``\\G``), but at the start of the text.
"""

from __future__ import annotations

import re
import warnings

#: ASCII blanks without the vertical tab, as the dialect's ``\s`` has them (fixed value).
_BLANK = r"\t\n\f\r "
_WORD = "0-9A-Za-z_"
_BOUNDARY = f"(?:(?<=[{_WORD}])(?![{_WORD}])|(?<![{_WORD}])(?=[{_WORD}]))"
_NO_BOUNDARY = f"(?:(?<=[{_WORD}])(?=[{_WORD}])|(?<![{_WORD}])(?![{_WORD}]))"
#: Names in brackets of the dialect's ASCII classes and Java's names for them (fixed values).
_CLASSES = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "ascii": r"\p{ASCII}", "blank": r"\t ", "cntrl": r"\p{Cntrl}", "digit": "0-9", "graph": r"\p{Graph}",
    "lower": "a-z", "print": r"\p{Print}", "punct": r"\p{Punct}", "space": r"\t\n\x0B\f\r ", "upper": "A-Z", "word": _WORD, "xdigit": "0-9A-Fa-f",
}
_PLAIN_ESCAPES = frozenset("aftnrdDwWAz")


class UnsupportedPattern(ValueError):
    """A pattern that is not one of the dialect, or has no Java counterpart."""


def _group_name(name: str, names: dict[str, str]) -> str:
    """Java's group names have letters and digits only."""
    if name not in names:
        names[name] = f"g{len(names)}x" + re.sub("[^A-Za-z0-9]", "", name)
    return names[name]


class _Reader:
    def __init__(self, source: str) -> None:
        self.s, self.at, self.out, self.names, self.groups = source, 0, [], {}, 0
        self.group_numbers: dict[str, int] = {}
        self.multiline = [False]

    def fail(self, what: str) -> None:
        raise UnsupportedPattern(f"{what} in {self.s!r}")

    def read(self) -> str:
        s = self.s
        while self.at < len(s):
            c = s[self.at]
            if c == "\\":
                self.escape(inside=False)
            elif c == "[":
                self.char_class()
            elif c == "(":
                self.group()
            elif c == ")":
                if len(self.multiline) == 1:
                    self.fail("a closing bracket too many")
                self.multiline.pop()
                self.out.append(c)
                self.at += 1
            elif c == "$":
                self.out.append("$" if self.multiline[-1] else r"\z")
                self.at += 1
            elif c in "*+?" or (c == "{" and re.match(r"\{\d+(,\d*)?\}", s[self.at :])):
                m = re.match(r"(?:[*+?]|\{\d+(?:,\d*)?\})\??", s[self.at :])
                self.out.append(m[0])
                self.at += m.end()
                if re.match(r"[*+]|\{\d+(,\d*)?\}", s[self.at :]) or s[self.at : self.at + 1] == "?":
                    self.fail("a repetition of a repetition")
            elif c == "{":
                self.out.append(r"\{")
                self.at += 1
            elif c == "}":
                self.out.append(r"\}")
                self.at += 1
            else:
                self.out.append(c)
                self.at += 1
        if len(self.multiline) > 1:
            self.fail("an open bracket")
        return "".join(self.out)

    def group(self) -> None:
        s, at = self.s, self.at
        if not s.startswith("(?", at):
            self.groups += 1
            self.multiline.append(self.multiline[-1])
            self.out.append("(")
            self.at += 1
            return
        if m := re.match(r"\(\?P?<([A-Za-z_][A-Za-z0-9_]*)>", s[at:]):
            self.groups += 1
            self.group_numbers[m[1]] = self.groups
            self.multiline.append(self.multiline[-1])
            self.out.append(f"(?<{_group_name(m[1], self.names)}>")
        elif m := re.match(r"\(\?([ims]*)(-[ims]+)?(:|\))", s[at:]):
            on, off = m[1], (m[2] or "").lstrip("-")
            multi = True if "m" in on else False if "m" in off else self.multiline[-1]
            if m[3] == ":":
                self.multiline.append(multi)
            else:
                self.multiline[-1] = multi
            on += "u" * ("i" in on)  # case folds over all letters, not ASCII alone
            self.out.append(f"(?{on}{'-' + off if off else ''}{m[3]}")
        else:
            self.fail(f"the group {s[at : at + 4]!r}")
        self.at += m.end()

    def escape(self, inside: bool) -> None:
        s, at = self.s, self.at
        c = s[at + 1 : at + 2]
        if not c:
            self.fail("a backslash at the end")
        self.at += 2
        if c == "Q":
            end = s.find(r"\E", self.at)
            end = len(s) if end < 0 else end
            self.out.append("".join(re.escape(x) for x in s[self.at : end]))
            self.at = min(len(s), end + 2)
        elif c == "s":
            self.out.append(_BLANK if inside else f"[{_BLANK}]")
        elif c == "S":
            self.out.append(f"[^{_BLANK}]")
        elif c == "v":
            self.out.append(r"\x0B")
        elif c in "bB" and not inside:
            self.out.append(_BOUNDARY if c == "b" else _NO_BOUNDARY)
        elif c in "pP" or c == "x":
            m = re.match(r"\{\^?[A-Za-z0-9_]+\}|[A-Za-z0-9]{%d}" % (2 if c == "x" else 1), s[self.at :])
            if not m:
                self.fail(f"\\{c}")
            body = m[0]
            if c != "x" and body.startswith("{^"):
                c, body = ("P" if c == "p" else "p"), "{" + body[2:]
            if c != "x" and len(body.strip("{}")) > 2:
                body = "{Is" + body.strip("{}") + "}"
            self.out.append(f"\\{c}{body}")
            self.at += m.end()
        elif c.isdigit():
            if m := re.match(r"0?[0-7]{1,3}", s[at + 1 :]) if c == "0" or re.match(r"[0-7]{3}", s[at + 1 :]) else None:
                self.out.append(f"\\x{{{int(m[0], 8):x}}}")
                self.at = at + 1 + m.end()
            else:
                self.fail("a back-reference")
        elif c in _PLAIN_ESCAPES and not (inside and c in "Az"):
            self.out.append(f"\\{c}")
        elif not c.isalnum() and ord(c) < 128:
            self.out.append(f"\\{c}")
        else:
            self.fail(f"\\{c}")

    def char_class(self) -> None:
        s = self.s
        self.out.append("[")
        self.at += 1
        if s[self.at : self.at + 1] == "^":
            self.out.append("^")
            self.at += 1
        first = True
        while True:
            c = s[self.at : self.at + 1]
            if not c:
                self.fail("an open class")
            if c == "]" and not first:
                self.out.append("]")
                self.at += 1
                return
            if m := re.match(r"\[:(\^?)([a-z]+):\]", s[self.at :]):
                if m[2] not in _CLASSES:
                    self.fail(m[0])
                self.out.append(f"[^{_CLASSES[m[2]]}]" if m[1] else _CLASSES[m[2]])
                self.at += m.end()
            elif c == "\\":
                self.escape(inside=True)
            else:
                self.out.append("\\" + c if c in "[]&" else c)
                self.at += 1
            first = False


def pattern(source: str) -> tuple[str, dict[str, int], int]:
    """(Java pattern, numbers of the named groups, number of groups)."""
    reader = _Reader(source)
    made = "(?d)" + reader.read()
    # Whether it matches nothing does not hang on which letters a class has.
    plain = re.sub(r"\[:\^?[a-z]+:\]|\\[pP](?:\{[^}]*\}|[A-Z])", "a", source).replace(r"\z", r"\Z")
    try:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            nothing = re.compile(plain).match("") is not None or re.compile(plain).search("a\n ") is not None and any(not m[0] for m in re.compile(plain).finditer("a\n b"))
    except re.error:
        nothing = True  # not known
    if nothing:
        made = rf"(?d)(?>{made[4:]})(?:(?!\G)|(?<=\A))"
    return made, reader.group_numbers, reader.groups


def replacement(template: str, names: dict[str, int], groups: int) -> str:
    """The template for Java: ``$1`` and ``${name}`` take the longest name, unknown groups are empty, ``$$`` is a dollar."""
    out, at = [], 0
    literal = lambda t: t.replace("\\", "\\\\").replace("$", "\\$")
    for m in re.finditer(r"\$(?:\$|\{(\w+)\}|(\w+))", template, re.ASCII):
        out.append(literal(template[at : m.start()]))
        at = m.end()
        name = m[1] or m[2]
        if name is None:
            out.append(r"\$")
            continue
        number = int(name) if name.isdigit() else names.get(name)
        if number is not None and number <= groups:
            out.append(f"${number}" if not template[at : at + 1].isdigit() else f"${number}\\{template[at]}")
            at += template[at : at + 1].isdigit()
    out.append(literal(template[at:]))
    return "".join(out)


def compile_rule(source: str, template: str) -> tuple[str, str]:
    """(pattern, replacement) for Spark's ``regexp_replace``."""
    made, names, groups = pattern(source)
    return made, replacement(template, names, groups)
