"""Parsers of XML documentation into blocks: DocBook, the nginx format, CNXML with formulas, and registries."""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable

from quarry.sources.markup import Outline, Parsed, squeeze, trimmed_code

_ENTITY = re.compile(r"&([A-Za-z_][\w.:-]*);")
_BUILT_IN = ("amp", "lt", "gt", "quot", "apos")


def resolve_entities(text: str, names_stay: bool = False) -> str:
    """Named entities as characters, without a document type; unknown ones as their names."""

    def one(match: re.Match) -> str:
        if match[1] in _BUILT_IN:
            return match[0]
        return match[1] if names_stay else html.entities.html5.get(match[1] + ";", match[1])

    return _ENTITY.sub(one, text)


def local(element: ET.Element) -> str:
    return element.tag.rpartition("}")[2] if isinstance(element.tag, str) else ""


def _root(text: str, names_stay: bool = False) -> ET.Element:
    try:
        return ET.fromstring(resolve_entities(text, names_stay))
    except ET.ParseError as error:
        raise ValueError(f"invalid XML: {error}") from error


def flat(element: ET.Element, special: Callable[[ET.Element], str | None] = lambda e: None) -> str:
    """The element's text; ``special`` may say how an element inside reads."""
    said = special(element)
    if said is not None:
        return said
    return (element.text or "") + "".join(flat(child, special) + (child.tail or "") for child in element)


def _children(element: ET.Element, *names: str) -> list[ET.Element]:
    return [child for child in element if local(child) in names]


def _docbook_special(element: ET.Element) -> str | None:
    name = local(element)
    if name == "citerefentry":
        parts = [squeeze(flat(e)) for n in ("refentrytitle", "manvolnum") for e in _children(element, n)[:1]]
        return f"{parts[0]}({parts[1]})" if len(parts) == 2 and all(parts) else "".join(parts)
    if name == "include":
        version = re.fullmatch(r"v(\d+)", element.get("xpointer", ""))
        return f"Added in version {version[1]}." if version else ""
    return None


# Roles of DocBook's elements.
DOCBOOK_SECTIONS = "refsect1 refsect2 refsect3 section chapter appendix refsynopsisdiv refsection".split()
DOCBOOK_CODE = "programlisting screen literallayout synopsis cmdsynopsis funcsynopsis".split()
DOCBOOK_NOTES = "note warning tip important caution example".split()
DOCBOOK_PROSE = "para simpara formalpara blockquote bridgehead".split()
DOCBOOK_SKIPPED = "refentryinfo refmeta refnamediv title".split()


def parse_docbook(text: str, fallback: str) -> Parsed:
    root, out = _root(text, True), Outline()
    say = lambda e: squeeze(flat(e, _docbook_special))

    def first(name: str) -> str:
        return next((value for e in root.iter() if local(e) == name and (value := say(e))), "")

    out.title = first("refentrytitle") or first("refname") or first("title") or fallback
    if purpose := first("refpurpose"):
        out.add(f"{out.title} — {purpose}", "paragraph", ["NAME"])

    def add(element: ET.Element, path: list[str], kind: str, value: str) -> None:
        anchor = element.get("{http://www.w3.org/XML/1998/namespace}id") or element.get("id") or ""
        out.add(value, kind, path, anchor=anchor)

    def visit(element: ET.Element, path: list[str]) -> None:
        name = local(element)
        label = next((say(t) for t in _children(element, "title")), "")
        if name in DOCBOOK_SKIPPED:
            return
        if name in DOCBOOK_SECTIONS or name in DOCBOOK_NOTES:
            label = label or {"refsynopsisdiv": "Synopsis"}.get(name, name.capitalize() if name in DOCBOOK_NOTES else "")
            for child in element:
                visit(child, [*path, label] if label else path)
        elif name == "varlistentry":
            term = ", ".join(filter(None, map(say, _children(element, "term"))))
            body = " ".join(map(say, _children(element, "listitem")))
            add(element, [*path, term] if term else path, "definition", f"{term}\n{body}".strip())
        elif name in ("itemizedlist", "orderedlist", "simplelist"):
            for item in _children(element, "listitem", "member"):
                add(item, path, "list_item", say(item))
        elif name in ("table", "informaltable"):
            for row in (e for e in element.iter() if local(e) == "row"):
                add(row, [*path, label] if label else path, "table_row", " | ".join(filter(None, map(say, _children(row, "entry", "td", "th")))))
        elif name in DOCBOOK_CODE:
            add(element, path, "code", trimmed_code(flat(element, _docbook_special)))
        elif name in DOCBOOK_PROSE:
            add(element, path, "paragraph", say(element))
        else:
            for child in element:
                visit(child, path)

    for child in root:
        visit(child, [])
    return out.parsed(fallback, "docbook")


def _nginx_special(element: ET.Element) -> str | None:
    if local(element) == "br":
        return "\n"
    if local(element) == "link" and not "".join(element.itertext()).strip():
        return element.get("id") or element.get("doc", "").rpartition("/")[2].rpartition(".")[0]
    return None


def parse_nginx_xml(text: str, fallback: str) -> Parsed:
    root, out = _root(text), Outline()
    if local(root) not in ("article", "module"):
        raise ValueError(f"unsupported root {local(root)}")
    out.title = squeeze(root.get("name", "")) or fallback
    say = lambda e: squeeze(flat(e, _nginx_special))

    def add(element: ET.Element, path: list[str], kind: str, value: str) -> None:
        out.add(value, kind, path, **{k: v for k, v in element.attrib.items() if k in ("id", "name", "rev")})

    def visit(element: ET.Element, path: list[str]) -> None:
        name = local(element)
        label = squeeze(element.get("name", ""))
        if name == "section":
            for child in element:
                visit(child, [*path, label] if label else path)
        elif name == "directive":
            label = label or "Directive"
            known = {n: list(filter(None, map(say, _children(element, n)))) for n in ("syntax", "default", "context", "appeared-in")}
            facts = [" ".join([label, " | ".join(known["syntax"])]).strip()]
            facts += [f"{title}: {mark.join(known[n])}" for n, title, mark in (("default", "Default", "; "), ("context", "Context", ", "), ("appeared-in", "Appeared in", ", ")) if known[n]]
            add(element, [*path, label], "definition", ". ".join(facts))
            for child in element:
                if local(child) not in known:
                    visit(child, [*path, label])
        elif name in ("para", "header"):
            add(element, path, "paragraph", say(element))
            for child in _children(element, "example", "programlisting", "note", "security", "migration"):
                visit(child, path)
        elif name in ("example", "programlisting", "c-def"):
            add(element, path, "code", trimmed_code(flat(element, _nginx_special)))
        elif name in ("note", "security", "migration"):
            add(element, path, "admonition", say(element))
        elif name in ("listitem", "item"):
            add(element, path, "list_item", say(element))
        elif name == "table":
            for row in (e for e in element.iter() if local(e) == "tr"):
                add(row, path, "table_row", " | ".join(filter(None, map(say, _children(row, "td", "th")))))
        else:
            for child in element:
                visit(child, path)

    for child in root:
        visit(child, [])
    return out.parsed(fallback, "nginx-xml")


def formula(element: ET.Element) -> str:
    """MathML on one line: fractions, roots, powers and indexes with brackets."""
    name, parts = local(element), [formula(child) for child in element]
    own = squeeze(element.text or "")
    pair = [*parts, "", ""]
    if name == "mfrac":
        return f"({pair[0]})/({pair[1]})"
    if name == "msqrt":
        return f"sqrt({' '.join(parts)})"
    if name == "mroot":
        return f"root({pair[0]}, {pair[1]})"
    if name in ("msup", "msub"):
        return f"{pair[0]}{'^' if name == 'msup' else '_'}({pair[1]})"
    if name == "msubsup":
        return f"{parts[0]}_({parts[1]})^({parts[2]})" if len(parts) > 2 else " ".join(parts)
    return " ".join(filter(None, [own, *parts]))


def parse_cnxml(text: str, fallback: str) -> Parsed:
    root, out = _root(text), Outline()
    say = lambda e: squeeze(flat(e, lambda x: f" {formula(x)} " if local(x) == "math" else None))
    out.title = next((say(e) for e in root if local(e) == "title"), "") or fallback

    def visit(element: ET.Element, path: list[str]) -> None:
        name = local(element)
        titles = _children(element, "title")
        label = say(titles[0]) if titles else ""
        if name in ("metadata", "title"):
            return
        if name in ("para", "item", "entry", "caption", "equation", "meaning", "term"):
            out.add(say(element), {"para": "paragraph", "item": "list_item", "equation": "formula"}.get(name, name), path, id=element.get("id", ""))
            return
        inside = [*path, label or "Glossary"] if name == "glossary" or (label and name in ("section", "note", "example", "exercise")) else path
        for child in element:
            visit(child, inside)

    for child in root:
        visit(child, [])
    return out.parsed(fallback, "cnxml")


def collection_modules(text: str) -> list[tuple[int, list[str], str]]:
    """A book's modules in reading order: (place, titles of the units around, module)."""
    found: list[tuple[int, list[str], str]] = []

    def visit(element: ET.Element, path: list[str]) -> None:
        if local(element) == "module":
            found.append((len(found), path, element.get("document", "")))
            return
        label = next((squeeze(flat(t)) for t in _children(element, "title")), "") if local(element) == "subcollection" else ""
        for child in element:
            visit(child, [*path, label] if label else path)

    visit(_root(text), [])
    return found


def registry_records(text: str) -> list[tuple[list[str], str, dict[str, list[str]]]]:
    """(registry titles, record id, fields with their values) of every record; a reference reads as its target."""
    root, found = _root(text), []

    def value(element: ET.Element) -> str:
        if local(element) == "xref":
            return element.get("data") or squeeze(flat(element))
        return squeeze(flat(element, lambda e: e.get("data") if local(e) == "xref" and e.get("data") else None))

    def visit(element: ET.Element, path: list[str]) -> None:
        title = next((squeeze(flat(t)) for t in _children(element, "title")), "") or element.get("id", "")
        here = [*path, title] if local(element) == "registry" else path
        place = 0
        for child in element:
            if local(child) == "registry":
                visit(child, here)
            elif local(child) == "record":
                fields: dict[str, list[str]] = {}
                for part in child:
                    if said := value(part):
                        fields.setdefault(local(part), [])
                        if said not in fields[local(part)]:
                            fields[local(part)].append(said)
                found.append((here, f"{'/'.join(here)}#{place}", fields))
                place += 1

    visit(root, [])
    return found


def render_record(fields: dict[str, list[str]]) -> str:
    """``Label: value`` lines; references last, in their order."""
    label = lambda n: {"xref": "References", "rfc": "RFC", "iana": "IANA"}.get(n, n.replace("_", " ").replace("-", " ").capitalize())
    names = [n for n in fields if n != "xref"] + [n for n in fields if n == "xref"]
    return "\n".join(f"{label(n)}: {', '.join(fields[n])}" for n in names)
