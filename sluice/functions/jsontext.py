"""JSON text to values and back, with numbers as written and at any depth.

The common case is left to the standard library's scanner. It gives up some thousand levels down; there a scanner with a stack
of its own takes over.
"""

from __future__ import annotations

import json
import re


class Number(str):
    """A number as written."""


_TOKEN = re.compile(r'[ \t\r\n]*(?:(?P<mark>[][{}:,])|(?P<text>"(?:[^"\\\x00-\x1f]+|\\(?:["\\/bfnrt]|u[0-9A-Fa-f]{4}))*")|(?P<number>-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)|(?P<word>true|false|null))')
_WORDS = {"true": True, "false": False, "null": None}


def _once(members: list[tuple[str, object]]) -> dict:
    seen: dict = {}
    for name, value in members:
        if name in seen:
            raise ValueError("a member stands there twice")
        seen[name] = value
    return seen


def _no_number(word: str) -> object:
    raise ValueError(f"{word} is no JSON number")


def read(text: str, strict: bool = False) -> object:
    """The value of a JSON text; numbers are ``Number``. Raises ValueError where it isn't JSON.

    A member that stands in an object twice counts with its last value; strict refuses it, and NaN and Infinity, which are numbers otherwise.
    """
    try:
        if strict:
            return json.loads(text, parse_float=Number, parse_int=Number, parse_constant=_no_number, object_pairs_hook=_once)
        return json.loads(text, parse_float=Number, parse_int=Number, parse_constant=Number)
    except RecursionError:
        return _read_deep(text, strict)


def _read_deep(text: str, strict: bool) -> object:
    top: list = []
    open_: list[list | dict] = [top]
    names: list[str | None] = [None]
    #: What may come next: v value, e value or end of an empty array, n name, f first name or end, c colon, s separator or end.
    want, at, end = "v", 0, len(text.rstrip(" \t\r\n"))
    while at < end:
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no JSON at {at}")
        at, mark, into = m.end(), m["mark"], open_[-1]
        if mark == ":" and want == "c":
            want = "v"
            continue
        if mark == "," and want == "s" and len(open_) > 1:
            want = "n" if isinstance(into, dict) else "v"
            continue
        if mark in ("]", "}") and len(open_) > 1 and isinstance(into, dict) == (mark == "}") and want in ("s", "f" if mark == "}" else "e"):
            open_.pop(), names.pop()
            want = "s"
            continue
        if m["text"] and want in "nf":
            name = json.loads(m["text"])
            if strict and name in into:
                raise ValueError("a member stands there twice")
            names[-1], want = name, "c"
            continue
        if want not in "ve" or mark in (":", ",", "]", "}"):
            raise ValueError(f"no JSON at {at}")
        value = [] if mark == "[" else {} if mark == "{" else json.loads(m["text"]) if m["text"] else Number(m["number"]) if m["number"] else _WORDS[m["word"]]
        if isinstance(into, dict):
            into[names[-1]] = value
        else:
            into.append(value)
        want = "s"
        if mark:
            open_.append(value), names.append(None)
            want = "e" if mark == "[" else "f"
    if len(open_) > 1 or len(top) != 1:
        raise ValueError("cut off")
    return top[0]


class _Piece(str):
    """Text that stands for itself."""


def write(value: object, ascii_only: bool = False) -> str:
    """Compact JSON text; numbers stay as written."""
    out: list[str] = []
    todo: list = [value]
    while todo:
        v = todo.pop()
        if isinstance(v, (_Piece, Number)):
            out.append(v)
        elif isinstance(v, dict):
            pieces: list = []
            for k, x in v.items():
                pieces += [_Piece(("," if pieces else "") + json.dumps(k, ensure_ascii=ascii_only) + ":"), x]
            todo += [_Piece("}"), *reversed(pieces), _Piece("{")]
        elif isinstance(v, list):
            pieces = []
            for x in v:
                pieces += [_Piece(","), x] if pieces else [x]
            todo += [_Piece("]"), *reversed(pieces), _Piece("[")]
        else:
            out.append(json.dumps(v, ensure_ascii=ascii_only))
    return "".join(out)


def plain(value: object) -> str | None:
    """A value as text: null stays null, text and numbers are as they are, booleans in lower case, structures are JSON."""
    if value is None or type(value) is str:
        return value
    return str(value) if isinstance(value, str) else write(value)
