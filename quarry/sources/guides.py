"""Repair guides: a page as a tree of elements, read by queries for its steps, lines, pictures, tools and details."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import unquote

from quarry.operators.chunking import split_lines
from quarry.sources.markup import VOID_TAGS, _Tokens, squeeze

_PATH = re.compile(r"(?i)(?:^|/)(guide|teardown)/([^/]+)/(\d+)")
# Markers and words that tell of danger, and members of a product that are kept.
RISKY_MARKERS = {"red", "yellow", "orange"}
RISKY_WORDS = re.compile(r"(?i)\b(?:warning|caution|danger)\b")
PRODUCT_MEMBERS = {
    "quantity": "quantity", "notes": "notes", "type": "type", "wikiUrl": "wiki_url", "wiki_url": "wiki_url", "productUrl": "source_url",
    "url": "source_url", "sku": "sku", "isOptional": "optional", "isoptional": "optional",
}


@dataclass
class Node:
    tag: str
    known: dict[str, str]
    children: list[Node | str] = field(default_factory=list)

    @property
    def classes(self) -> list[str]:
        return self.known.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def all(self, test: Callable[[Node], bool]) -> list[Node]:
        """Elements that pass, outermost only."""
        out = []
        for child in self.children:
            if isinstance(child, Node):
                out += [child] if test(child) else child.all(test)
        return out

    def text(self) -> str:
        return squeeze(" ".join(c if isinstance(c, str) else c.text() for c in self.children))


def tree(html: str) -> Node:
    """End tags close the last element of their name; those without one close nothing."""
    tokens = _Tokens()
    tokens.feed(html)
    tokens.close()
    open_ = [Node("", {})]
    for e in tokens.events:
        if e.step > 0 or e.tag in VOID_TAGS:
            node = Node(e.tag, e.attributes)
            open_[-1].children.append(node)
            open_ += [node] * (e.step > 0)
        elif e.step < 0:
            at = next((i for i in range(len(open_) - 1, 0, -1) if open_[i].tag == e.tag), len(open_))
            del open_[at:]
        else:
            open_[-1].children.append(e.text)
    return open_[0]


@dataclass(frozen=True)
class Line:
    text: str
    level: int
    marker: str | None


@dataclass(frozen=True)
class Step:
    number: int
    title: str
    lines: list[Line]
    images: list[dict[str, str]]


@dataclass(frozen=True)
class Guide:
    guide_id: str
    kind: str
    title: str
    url: str | None
    summary: str
    category: str
    difficulty: str
    time_required: str
    published: str
    modified: str
    tools: list[dict]
    parts: list[dict]
    steps: list[Step]


def _product(item: dict) -> dict | None:
    name = squeeze(str(item.get("name") or item.get("text") or item.get("title") or ""))
    return {"name": name} | {to: item[of] for of, to in PRODUCT_MEMBERS.items() if item.get(of) not in (None, "", False)} if name else None


def _is_step(n: Node) -> bool:
    return (n.tag == "li" and "step-wrapper" in n.classes) or (n.tag == "div" and n.known.get("itemtype", "").endswith("/HowToStep"))


def _lines(step: Node) -> list[Line]:
    out, level, marker = [], 0, None

    def read(n: Node, in_list: bool) -> None:
        nonlocal level, marker
        in_list = in_list or (n.tag == "ul" and "step-lines" in n.classes)
        if n.tag == "li" and (in_list or n.known.get("itemtype", "").endswith("/HowToDirection")):
            depth, icon = (re.search(p, n.known.get("class", ""), re.I) for p in (r"level-(\d+)", r"(?:bullet-line-icon|ico-step-icon)-([a-z]+)"))
            level, marker = int(depth[1]) if depth else 0, icon[1].lower() if icon else None
        elif n.tag == "div":
            bullet = next((c[7:] for c in n.classes if c.startswith("bullet_") and c != "bullet_black"), None)
            marker = bullet or next((c.rpartition("-")[2] for c in n.classes if "step-icon-" in c), marker)
        elif n.tag == "p" and (in_list or n.known.get("itemprop", "").lower() == "text"):
            if said := n.text():
                out.append(Line(said, level, marker))
            return
        for child in n.children:
            if isinstance(child, Node):
                read(child, in_list)

    read(step, False)
    return out


def _images(step: Node) -> list[dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for n in step.walk():
        source = n.known.get("data-biggest") or n.known.get("src") if n.tag == "img" else None
        if source:
            source = re.sub(r"^\.\./\.\./images/(https?)/", r"\1://", source)
            words = squeeze(n.known.get("alt", ""))
            if words or "guide-images" in source:
                out.setdefault(source, {"url": source} | ({"alt": words} if words else {}))
    return list(out.values())


def _step(n: Node, place: int) -> Step:
    def first(tag: str, name: str) -> str:
        return next((x.text() for x in n.walk() if x.tag == tag and name in x.classes), "")

    said, given = re.search(r"\d+", first("strong", "stepValue")), n.known.get("data-step-number", "")
    number = int(said[0]) if said else int(given) if given.isdigit() else place
    return Step(number, first("span", "stepTitleTitle") or f"Step {number}", _lines(n), _images(n))


def parse_guide(path: str, html: str) -> Guide | None:
    """None for a page that is no guide or teardown, or has no steps."""
    where = _PATH.search(unquote(path))
    if not where:
        return None
    root = tree(html)
    every = list(root.walk())
    meta = {(n.known.get("name") or n.known.get("itemprop") or "").lower(): squeeze(n.known.get("content", "")) for n in every if n.tag == "meta" and n.known.get("content")}
    heads = [n.text() for tag in ("h1", "title") for n in every if n.tag == tag and n.text()]
    title = re.sub(r"(?i)\s+-\s+\w+$", "", meta.get("title", "")) or (heads or [""])[0]
    steps = [_step(n, k) for k, n in enumerate(root.all(_is_step), 1)]
    steps = [s for s in steps if s.lines]
    if not title or not steps:
        return None
    data = {}
    for n in every:
        if n.known.get("data-name") in ("GuideTopComponent", "FlagSectionComponent"):
            try:
                data[n.known["data-name"]] = json.loads(n.known.get("data-props", ""))
            except ValueError:
                continue
    top = (data.get("GuideTopComponent") or {}).get("productData") or {}

    def products(name: str, kind: str) -> list[dict]:
        given = [p for item in top.get(name, []) if isinstance(item, dict) and (p := _product(item))]
        listed = [n for n in every if n.tag == "div" and f"item-list-{name}" in n.classes]
        return given + [{"name": x.text()} for n in listed for x in n.walk() if x.tag == "p" and x.known.get("itemprop", "").lower() == "name" and x.text()]

    def detail(test: Callable[[str], bool]) -> str:
        found = (x.text() for n in every if n.tag == "div" and "details-item" in n.classes and test(n.known["class"].lower()) for x in n.walk() if x.tag == "p" and "item-value" in x.classes)
        return next(found, "")

    flags = data.get("FlagSectionComponent") or {}
    words = [squeeze(w) for w in meta.get("keywords", "").split(",") if squeeze(w)]
    short = re.sub(r" (?:Replacement|Teardown)$", "", title)
    canonical = next((n.known.get("href") for n in every if n.tag == "link" and "canonical" in n.known.get("rel", "").lower()), None)
    return Guide(
        where[3], where[1].lower(), title, canonical, meta.get("description", ""), words[1] if len(words) > 1 else short if short != title else squeeze(re.sub("[+_]", " ", where[2])),
        detail(lambda c: "difficulty" in c) or squeeze(str(flags.get("difficultyName") or "")), detail(lambda c: "time" in c) or squeeze(str(flags.get("timeRequired") or "")),
        meta.get("datepublished", ""), meta.get("datemodified", ""), products("tools", "tool"), products("parts", "part"), steps,
    )


def guide_chunks(guide: Guide, most: int = 3200) -> list[tuple[list[str], str, dict]]:
    """(headings, text, attributes): an overview, then every step by its lines."""
    listed = [f"{label}: " + "; ".join(p["name"] for p in items) for label, items in (("Tools", guide.tools), ("Parts", guide.parts)) if items]
    details = "; ".join(filter(None, (guide.difficulty, guide.time_required)))
    overview = [guide.title, guide.summary, *listed, details and f"Difficulty and time: {details}"]
    out = [([guide.title, "Overview"], "\n".join(filter(None, overview)), {"kind": "overview", "section_index": 0, "chunk_index": 0})]
    for k, step in enumerate(guide.steps, 1):
        plain = f"Step {step.number}"
        own = [] if step.title == plain else [step.title]
        lines = [": ".join([plain, *own]), *("  " * x.level + "- " + (f"[{x.marker.upper()}] " if x.marker else "") + x.text for x in step.lines)]
        risky = any(x.marker in RISKY_MARKERS or RISKY_WORDS.search(x.text) for x in step.lines)
        for part, text in enumerate(split_lines("\n".join(lines), most)):
            out.append(([guide.title, plain, *own], text, {"kind": "procedure_step", "step_number": step.number, "step_title": step.title, "step_part": part, "safety_sensitive": risky, "images": step.images, "section_index": k, "chunk_index": len(out)}))
    return out
