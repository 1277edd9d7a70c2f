"""Extractor of shell scripts: functions, and the files that they source.

One pass over the characters knows three things: which quotes and parentheses are open, whether a command may begin
here, and which here-documents begin on the next line.
"""

from __future__ import annotations

from tessera.operators.extract.records import Records, inside

_ENDS_WORD = frozenset(" \t\n;&|()<>'\"")
_BEFORE_COMMAND = frozenset(("then", "do", "else", "elif"))
_NAME_START = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_")
# What names the running script, and its folder.
_SCRIPT = ("$0", "${0}", "$BASH_SOURCE", "${BASH_SOURCE}", "${BASH_SOURCE[0]}")
_FOLDER = ("${0%/*}/", "${BASH_SOURCE%/*}/", "${BASH_SOURCE[0]%/*}/")
#: Letters, digits and the signs that names may have become underscores.
_NAME_SIGNS = {c: "_" for c in range(128) if chr(c).isalnum() or chr(c) in ":.-"}
#: Characters that the shell would expand.
_EXPANDS = frozenset("$`*?[~{")


def _argument(text: str, at: int) -> str:
    """The word that begins at a place of a line, with quotes and substitutions whole."""
    start = at
    while at < len(text) and text[at] not in " \t\n;&|()":
        if text[at] in "'\"":
            close = text.find(text[at], at + 1)
            if close < 0 or "\n" in text[at:close]:
                break
            at = close
        elif text.startswith("$(", at):
            depth, close = 0, at + 1
            while close < len(text) and text[close] != "\n":
                depth += (text[close] == "(") - (text[close] == ")")
                if not depth:
                    break
                close += 1
            if depth:
                break
            at = close
        at += 1
    return text[start:at]


def _beside_script(word: str) -> str | None:
    """The rest of a word that begins with the script's folder."""
    for folder in _FOLDER:
        if word.startswith(folder):
            return word[len(folder) :]
    inner, close, rest = word.partition(")/")
    if close and inner.startswith("$("):
        command = inner[2:].split()
        if len(command) == 2 and command[0] == "dirname" and command[1] in _SCRIPT:
            return rest
    return None


def _candidates(folder: str, word: str) -> list[str | None]:
    """From the script's folder; a plain name may also be meant from the caller's, which is taken to be the root."""
    own = _beside_script(word)
    rest = word if own is None else own
    if _EXPANDS.intersection(rest) or own is None and rest.startswith("/"):
        return []
    rest = rest.lstrip("/")
    return [inside(folder, rest)] if own is not None else [inside(folder, rest), inside("", rest)]


def _word(text: str, at: int) -> str:
    """The plain word that begins at a place, up to a sign, quote or substitution."""
    end = at
    while end < len(text) and text[end] not in _ENDS_WORD and text[end] != "\\" and not text.startswith("$(", end):
        end += 1
    return text[at:end]


def _blanks(text: str, at: int) -> int:
    while text[at : at + 1] in (" ", "\t") and at < len(text):
        at += 1
    return at


def _function(text: str, at: int) -> str | None:
    """The name of the function whose definition begins at a place: a word before empty parentheses, or after the word function.
    Its body opens with a brace or parenthesis, on the line or on another."""
    at = _blanks(text, at)
    name = _word(text, at)
    at = _blanks(text, at + len(name))
    keyword = name == "function"
    if keyword:
        name = _word(text, at)
        at = _blanks(text, at + len(name))
    called = text.startswith("(", at) and text.startswith(")", inner := _blanks(text, at + 1))
    if called:
        at = _blanks(text, inner + 1)
    if not (keyword or called) or text[at : at + 1] not in ("", "\n", "{", "(", "#"):
        return None
    return name if _NAME_START.intersection(name[:1]) and not name.translate(_NAME_SIGNS).strip("_") else None


def _here_mark(text: str, at: int) -> tuple[str, bool] | None:
    """The word that ends a here-document which begins after <<, and whether tabs before it are left out."""
    tabs = text.startswith("-", at)
    word = _argument(text, _blanks(text, at + tabs))
    mark = word[1:-1] if len(word) > 2 and word[0] == word[-1] and word[0] in "'\"" else _word(word, 0)
    return (mark, tabs) if _NAME_START.intersection(mark[:1]) and not mark.translate(_NAME_SIGNS).strip("_") else None


def shell(text: str, out: Records) -> None:
    lines = text.split("\n")
    open_: list[str] = []  # closing signs of double quotes and parentheses
    marks: list[tuple[str, bool]] = []
    at, number, command, fresh = 0, 1, True, True

    while at < len(text):
        c = text[at]
        if c == "\n":
            at, number = at + 1, number + 1
            for mark, tabs in marks:
                while number <= len(lines):
                    line = lines[number - 1]
                    at, number = at + len(line) + 1, number + 1
                    if (line.lstrip("\t") if tabs else line) == mark:
                        break
            marks, command, fresh = [], True, True
            continue
        quoted = open_[-1:] == ['"']
        if not quoted and fresh:
            fresh = False
            if name := _function(text, at):
                out.node("function", name, number)
        if c == "\\":
            number += text.startswith("\n", at + 1)
            at, command = at + 2, False
        elif text.startswith("$(", at):
            open_.append(")")
            at, command = at + 2, True
        elif quoted:
            if c == '"':
                open_.pop()
            at += 1
            fresh = False
        elif c in " \t":
            at += 1
        elif c == "#" and (at == 0 or text[at - 1] in " \t\n;&|("):
            at += len(text[at:].split("\n", 1)[0])
        elif c == "'":
            close = text.find("'", at + 1)
            close = len(text) if close < 0 else close
            number += text.count("\n", at, close)
            at, command = close + 1, False
        elif c == '"':
            open_.append('"')
            at, command = at + 1, False
        elif c in ";&|(":
            if c == "(":
                open_.append(")")
            at, command = at + 1, True
        elif c == ")":
            if open_[-1:] == [")"]:
                open_.pop()
            at, command = at + 1, False
        elif text.startswith("<<", at) and not text.startswith("<<<", at):
            if mark := _here_mark(text, at + 2):
                marks.append(mark)
            at += 2
        elif c in "<>":
            at += 1 if c == ">" else len(text[at : at + 3]) - len(text[at : at + 3].lstrip("<"))
        else:
            word = _word(text, at)
            end = at + len(word)
            if command and word in ("source", ".") and text[end : end + 1] in (" ", "\t"):
                while text[end : end + 1] in (" ", "\t"):
                    end += 1
                name = _argument(text, end).replace('"', "").replace("'", "")
                if name:
                    out.reference("sources", name, number, _candidates(out.folder, name))
                end += len(_argument(text, end))
            command = command and word in _BEFORE_COMMAND
            at = max(end, at + 1)
