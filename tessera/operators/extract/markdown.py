"""Extractors of Markdown: headings in their hierarchy, and links to files.

A document is cut into blocks first. Front matter, fenced code and comments are masked over the whole text, so that line numbers
stay. Each line then has a kind, runs of lines of text are paragraphs, and a paragraph of one line above an underline is a
heading. Links are looked for in the lines of paragraphs and headings, last.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from urllib.parse import urlsplit

from tessera.operators.extract.records import Records, inside

_FRONT = re.compile(r"\A[ \t]*---[ \t]*\n.*?^[ \t]*(?:---|\.\.\.)[ \t]*$", re.M | re.S)
# a fence lasts to the next line that begins with as many of its signs
_FENCE = r"^ {0,3}(?P<mark>(?P<sign>[`~])(?P=sign){2,})[^\n]*(?:\n(?! {0,3}(?P=mark))[^\n]*)*(?:\n[^\n]*)?"
_MASKED = re.compile(rf"{_FENCE}|(?P<comment><!--.*?(?:-->|\Z))", re.M | re.S)
_FENCED = re.compile(_FENCE, re.M)
#: Signs that, as a word of their own, begin a list, a quote or a table.
_OPENERS = frozenset("-*+>|")


@dataclass
class _Line:
    number: int
    kind: str  # blank, code, heading, underline or text
    text: str
    level: int = 0


def _hidden(m: re.Match) -> str:
    """Line ends stay. A comment within a line leaves a blank."""
    return "\n" * m[0].count("\n") or " "


def _kind(number: int, line: str) -> _Line:
    body = line.strip()
    if not body:
        return _Line(number, "blank", "")
    # only what a line begins with tells: long lines are not gone through
    if line[0] in " \t" and line[:4].expandtabs(4).startswith("    "):
        return _Line(number, "code", "")
    if body[0] in "=-" and len(set(body)) == 1:
        return _Line(number, "underline", "", 1 if body[0] == "=" else 2)
    if body[0] != "#":
        return _Line(number, "text", line)
    marks, *title = body.split(None, 1)
    if len(marks) < 7 and not marks.strip("#"):
        words = title[0].rsplit(None, 1) if title else []
        if words and not words[-1].strip("#"):  # a closing run of number signs
            words.pop()
            return _Line(number, "heading", words[0] if words else "", len(marks))
        return _Line(number, "heading", title[0] if title else "", len(marks))
    return _Line(number, "text", line)


def _lines(text: str, masked: re.Pattern) -> Iterator[_Line]:
    whole = masked.sub(_hidden, text)
    return (_kind(k, line) for k, line in enumerate(whole.split("\n"), 1))


def _without_code(line: str) -> str:
    """A line without its code spans: from back-ticks to as many, or to fewer where so many don't come again."""
    if "`" not in line:
        return line
    out, at = [], 0
    while at < len(line):
        plain = line.find("`", at)
        if plain != at:
            plain = len(line) if plain < 0 else plain
            out.append(line[at:plain])
            at = plain
            continue
        run = len(line[at:]) - len(line[at:].lstrip("`"))
        for n in range(run, 0, -1):
            if (close := line.find("`" * n, at + n)) >= 0:
                at = close + n
                break
        else:
            out.append("`")
            at += 1
    return "".join(out)


def _title_ends(text: str) -> int:
    """How much of what follows a destination is blanks and a title, before the closing parenthesis; -1 if there is more."""
    rest = text.lstrip(" \t")
    at = len(text) - len(rest)
    if at and rest[:1] in ("'", '"', "("):
        close = rest.find(")" if rest[0] == "(" else rest[0], 1)
        if close < 0 or "(" in rest[1:close] and rest[0] == "(":
            return -1
        tail = rest[close + 1 :]
        at += close + 1 + len(tail) - len(tail.lstrip(" \t"))
    return at if text.startswith(")", at) else -1


def _destination(text: str, plain: bool) -> tuple[str, int] | None:
    """What an opened parenthesis links to, and where it ends. plain: without angles, titles and blanks."""
    at = 0 if plain else len(text) - len(text.lstrip(" \t"))
    angle = not plain and text.startswith("<", at)
    target = re.match(r"[^\s()]*" if plain else r"[^\s()<>]*", text[at + angle :])[0]
    at += angle + len(target)
    if plain:
        end = 0 if text.startswith(")", at) else -1
    else:
        at += text.startswith(">", at)
        end = _title_ends(text[at:])
    return (target, at + end + 1) if target and end >= 0 else None


def _inline(text: str, plain: bool = False) -> Iterator[str]:
    """Destinations of the inline links of a line that has no code; images are none.

    The text is cut where a label ends and a parenthesis opens. A label has begun if its stretch, since the last bracket
    that closed or link that ended, has an opening bracket that no exclamation mark makes an image's.
    """
    before, *after = text.split("](")
    for part in after:
        stretch = before.rpartition("]")[2]
        found = _destination(part, plain) if re.search(r"(?:^|[^!])\[", stretch) else None
        if found:
            yield found[0]
        before = part[found[1] :] if found else part


def _defined(text: str) -> str | None:
    """What the definition of a link's name leads to; footnotes are none."""
    name, colon, target = text.strip().partition("]:")
    if not colon or name[:1] != "[" or len(name) < 2 or name[1] == "^" or "]" in name:
        return None
    return re.split(r"[\s<>]", target.strip().removeprefix("<"), maxsplit=1)[0] or None


def _label(title: str) -> str:
    """A heading's text: links and images become their own text, back-ticks go, and blanks become single spaces."""
    return " ".join(re.sub(r"!?\[([^\]]*)\]\([^)]*\)", r"\1", title).replace("`", "").split())


def _in_repository(target: str) -> bool:
    """Neither a place of this page, nor one from the root, nor one with a scheme."""
    try:
        return len(target) <= 4096 and min(target) >= " " and target[0] not in "/#" and not urlsplit(target).scheme
    except ValueError:
        return True


def _link(out: Records, target: str, number: int) -> None:
    if _in_repository(target):
        out.reference("links_to", target, number, [inside(out.folder, target.split("#")[0].split("?")[0])])


def _headings(lines: list[_Line]) -> Iterator[_Line]:
    """Headings of both forms, in order."""
    paragraphs = [list(run) for _, run in groupby(lines, lambda x: "text" if x.kind in ("text", "code") else x.number)]
    for run, after in zip(paragraphs, [*paragraphs[1:], []], strict=True):
        one = run[0]
        if one.kind == "heading":
            yield one
        elif len(run) == 1 and one.kind == "text" and after and after[0].kind == "underline":
            first = one.text.split(None, 1)[0]
            numbered = first[:-1].isdecimal() and first[-1] in ".)"
            if not numbered and first not in _OPENERS and not _defined(_without_code(one.text)):
                yield _Line(one.number, "heading", one.text, after[0].level)


def markdown(text: str, out: Records) -> None:
    """Headings of both forms, each below the nearest one before of a lower level, and links: inline ones where they
    stand, named ones where their name is defined. Front matter, code and comments are passed over."""
    text = "\n".join(text.splitlines())
    lines = list(_lines(_FRONT.sub(_hidden, text, count=1), _MASKED))
    above: list[tuple[int, str]] = []
    for x in _headings(lines):
        label = _label(x.text)
        if 0 < len(label) <= 4096 and min(label) >= " ":
            while above and above[-1][0] >= x.level:
                above.pop()
            above.append((x.level, out.node("heading", label, x.number, parent=above[-1][1] if above else None)))
    for x in lines:
        if x.kind in ("text", "heading"):
            own = _without_code(x.text)
            named = _defined(own) if x.kind == "text" else None
            for target in ([named] if named else []) + list(_inline(own)):
                _link(out, target, x.number)


def markdown_links(text: str, out: Records) -> None:
    """Plain inline links alone, outside code: the first version of the extractor."""
    whole = _FENCED.sub(_hidden, "\n".join(text.splitlines()))
    for number, line in enumerate(whole.split("\n"), 1):
        if not line.startswith(("    ", "\t")):
            for target in _inline(_without_code(line), plain=True):
                _link(out, target, number)
