"""Go source: the package's own comment and its exported declarations, bodies aside, with the comments above them.

Comments and literals are blanked first, so that braces and key words inside count for nothing; places stay the same,
and what is put out is cut from the source itself.
"""

from __future__ import annotations

import itertools
import re
from pathlib import PurePosixPath

from quarry.sources.markup import Outline, Parsed, squeeze, trimmed_code

_NO_CODE = re.compile(r"""//[^\n]*|/\*.*?(?:\*/|\Z)|"(?:\\.|[^"\\])*(?:"|\Z)|'(?:\\.|[^'\\])*(?:'|\Z)|`[^`]*(?:`|\Z)""", re.S)
_DECLARATION = re.compile(
    r"^[ \t]*(?:func\s+(?:\((?P<receiver>[^)]+)\)\s*)?(?P<func>[A-Z]\w*)\b|type\s+(?P<type>[A-Z]\w*)\b"
    r"|(?P<of>var|const)\s+(?:(?P<value>[A-Z]\w*)\b|(?P<group>\()))",
    re.M,
)
_NOTE = re.compile(r"((?:^[ \t]*//[^\n]*\n)+|/\*(?:(?!\*/).)*\*/[ \t]*\n)\Z", re.M | re.S)
_LEVEL = {"(": 1, "[": 1, "{": 1, ")": -1, "]": -1, "}": -1}


def masked(text: str) -> str:
    return _NO_CODE.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text)


def _levels(code: str) -> list[int]:
    """How many brackets are open before each character."""
    return list(itertools.accumulate((_LEVEL.get(c, 0) for c in code), initial=0))


def _note_before(text: str, at: int) -> str:
    """The comment that ends right above a place, without its signs."""
    found = _NOTE.search(text, 0, at)
    if not found:
        return ""
    body = re.sub(r"\A\s*/\*|\*/\s*\Z", "", found[0]) if found[0].lstrip().startswith("/*") else found[0]
    return squeeze(re.sub(r"(?m)^[ \t]*(?://|\*)[ \t]?", "", body))


def parse_go(text: str, fallback: str, path: str = "") -> Parsed:
    text = re.sub(r"\r\n?", "\n", text)
    code = masked(text)
    level = _levels(code)
    named = re.search(r"(?m)^[ \t]*package\s+([A-Za-z_]\w*)", code)
    package = named[1] if named else "unknown"
    folders = PurePosixPath(path).parts[:-1]
    if "src" in (lower := [f.lower() for f in folders]):
        package = "/".join(folders[lower.index("src") + 1 :]) or package
    out = Outline()
    out.title = f"package {package} — {PurePosixPath(path).stem or fallback}"
    root = f"package {package}"
    if named:
        out.add(_note_before(text, named.start()), "paragraph", [root], go_kind="package")

    def closing(start: int, opens: str) -> int:
        """Behind the bracket that closes the next one of this kind; the line's end if there is none."""
        first = code.find(opens, start)
        if first >= 0:
            end = next((i + 1 for i in range(first + 1, len(code)) if level[i + 1] == level[first]), None)
            if end:
                return end
        return code.find("\n", start) % (len(code) + 1)

    def signature(start: int) -> int:
        """The body's brace, or the end of the line, behind the parameters."""
        inside = code.find("(", start)
        return next((i for i in range(max(inside, start), len(code)) if i > inside >= 0 and level[i] == level[start] and code[i] in "{\n"), len(code))

    for m in _DECLARATION.finditer(code):
        if level[m.start()]:
            continue
        if m["func"]:
            owner = squeeze(m["receiver"] or "")
            kind, name, head = ("method" if owner else "function"), m["func"], (f"method ({owner}) {m['func']}" if owner else f"func {m['func']}")
            end = signature(m.end())
        elif m["type"]:
            kind, name, head = "type", m["type"], f"type {m['type']}"
            end = closing(m.end(), "{")
        elif m["group"]:
            kind, name, head = m["of"], f"{m['of']}s", f"{m['of']}s".capitalize()
            end = closing(m.end() - 1, "(")
        else:
            kind, name, head = m["of"], m["value"], f"{m['of']} {m['value']}"
            end = code.find("\n", m.start()) % (len(code) + 1)
        parts = [_note_before(text, m.start()), trimmed_code(text[m.start() : end])]
        out.add("\n\n".join(filter(None, parts)), "go-declaration", [root, head], go_kind=kind, go_name=name)
    return out.parsed(fallback, "go")
