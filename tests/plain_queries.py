"""Plain versions of the registered queries that SQL cannot express, from their rules: lists of dicts for a folder of
tables."""

import hashlib
import html
import math
import re
from collections import defaultdict

import duckdb
import regex

from quarry.functions import ranking
from quarry.functions.text import technical_plain
from quarry.operators.lexical import STOP_WORDS

PLAIN = {}


def plain(f):
    PLAIN[f.__name__] = f
    return f


def rows(sf, name, columns):
    found = duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'")
    return [dict(zip(found.columns, r, strict=True)) for r in found.fetchall()]


def tokens(text):
    import unicodedata

    out = []
    for run in regex.findall(r"[\p{L}\p{N}\p{Co}\p{Mn}]+", (text or "").lower()):
        out.append("".join(c for c in unicodedata.normalize("NFD", run) if not unicodedata.combining(c)) if run != "\u00df" else run)
    return [unicodedata.normalize("NFC", t) for t in out if t]


def planned(text):
    every = tokens(text)
    return [t for t in every if t not in STOP_WORDS] or every


class Bm25:
    def __init__(self, docs, fields):
        self.docs = docs
        self.tf = [defaultdict(float) for _ in docs]
        length = [0] * len(docs)
        for k, d in enumerate(docs):
            for weight, words in ((w, f(d)) for w, f in fields):
                length[k] += len(words)
                for t in words:
                    self.tf[k][t] += weight
        self.df = defaultdict(int)
        for tf in self.tf:
            for t in tf:
                self.df[t] += 1
        mean = sum(length) / len(docs)
        self.norm = [1.2 * (0.25 + 0.75 * n / mean) for n in length]

    def search(self, terms, every, limit):
        """(score, place) of rows with any or every term, the best first."""
        found = []
        for k, tf in enumerate(self.tf):
            has = [t for t in terms if t in tf]
            if has and (len(has) == len(terms) or not every):
                score = 0.0
                for t in has:
                    idf = math.log((len(self.docs) - self.df[t] + 0.5) / (self.df[t] + 0.5))
                    score -= (idf if idf > 0 else 1e-6) * tf[t] * 2.2 / (tf[t] + self.norm[k])
                found.append((round(score, 9), self.docs[k]["doc_id"], k, score))
        return sorted(found)[:limit]


def index(sf, technical=False):
    docs = rows(sf, "documents", "doc_id, text, lang, source")
    fields = [(5.0, lambda d: tokens(d["source"])), (2.0, lambda d: tokens(d["lang"])), (1.0, lambda d: tokens(d["text"]))]
    if technical:
        fields.append((2.0, lambda d: tokens(technical_plain(" ".join([d["source"] or "", d["lang"] or "", d["text"] or ""])))))
    return Bm25(docs, fields)


@plain
def technical_alias(sf):
    return [{"doc_id": r["doc_id"], "technical": by_rules(r["text"] or "")} for r in rows(sf, "documents", "doc_id, text")]


def by_rules(text):
    """One name after the other, each over the whole text."""
    hits = 0
    for pattern, name in ((r"(?i)(?<![\w+])c\+\+(?!\+)", "cpp"), (r"(?i)(?<![\w#])c#(?!#)", "csharp"), (r"(?i)(?<!\w)\.net(?!\w)", "dotnet")):
        text, n = re.subn(pattern, f" {name} ", text)
        hits += n
    for pattern, prefix in ((r"\b[A-Za-z_]\w*(?:::[A-Za-z_]\w*)+\b", "scope"), (r"\b[A-Za-z]\w*(?:_\w+)+\b", "ident")):
        text, n = re.subn(pattern, lambda m, p=prefix: f" {p}{hashlib.sha256(m[0].casefold().encode()).hexdigest()[:20]} ", text)
        hits += n
    return " ".join(w.casefold() for w in re.findall(r"[^\W_]+", text)) if hits else ""


@plain
def bm25_four_fields(sf):
    held, out = index(sf, True), []
    for q in rows(sf, "benchmark", "item_id, text"):
        for rank, (_, doc_id, _, score) in enumerate(held.search(planned(q["text"]), False, 10), 1):
            out.append({"query_id": q["item_id"], "row_id": doc_id, "score": round(score, 6), "rank": rank})
    return out


def titled(held, terms, limit):
    """AND search with the first document of an exact title before the others: (doc_id, reason)."""
    found = [(i, "bm25") for _, i, _, _ in held.search(terms, True, limit + 1)]
    exact = sorted(d["doc_id"] for d in held.docs if (d["source"] or "").lower() == " ".join(terms))
    if exact:
        found = [(exact[0], "exact_title"), *((i, r) for i, r in found if i != exact[0])]
    return found[:limit]


@plain
def query_relaxation(sf):
    held, out = index(sf), []
    title = {d["doc_id"]: d["source"] for d in held.docs}
    for q in rows(sf, "benchmark", "item_id, text"):
        terms = planned(q["text"])
        tried, variants = {" ".join(terms)}, [(terms, titled(held, terms, 160), 1.0)]
        relaxed = len(terms) >= 4 and not any(r == "exact_title" for _, r in variants[0][1])

        def windows():
            for width, weight in ((4, 0.65), (3, 0.55)):
                for at in range(min(len(terms) - width + 1, 6)):
                    own = terms[at : at + width]
                    if " ".join(own) not in tried:
                        tried.add(" ".join(own))
                        variants.append((own, titled(held, own, 160), weight))
                        if variants[-1][1]:
                            return True
            return False

        if relaxed:
            hit = len(terms) > 6 and windows()
            if not hit:
                for drop in range(min(len(terms), 6)):
                    own = terms[:drop] + terms[drop + 1 :]
                    if " ".join(own) not in tried:
                        tried.add(" ".join(own))
                        variants.append((own, titled(held, own, 160), 0.8))
            if not hit and not variants[0][1] and len(terms) > 4:
                windows()
        scores, names, reasons = defaultdict(float), defaultdict(set), {}
        for own, hits, weight in variants:
            for rank, (i, reason) in enumerate(hits, 1):
                scores[i] += weight / (60 + rank)
                names[i].add(" ".join(own))
                reasons.setdefault(i, reason)
        for i in list(scores):
            own = planned(title[i])
            if len(set(own)) >= 2 and set(own) <= set(terms) and [j for j, _ in titled(held, own, 1)] == [i]:
                scores[i] += 1
                reasons[i] = "relaxed_exact_title" if relaxed else "exact_title"
        for position, i in enumerate(sorted(scores, key=lambda i: (-round(scores[i], 12), i))[:5], 1):
            out.append({"query_id": q["item_id"], "document_id": i, "fusion_score": round(scores[i], 9), "position": position, "relaxed": relaxed, "matched_variants": "|".join(sorted(names[i])), "reason": reasons[i]})
    return out


def content_id(text):
    import unicodedata

    text = re.sub(r"[ \t]+\n", "\n", unicodedata.normalize("NFC", text or "").replace("\r\n", "\n").replace("\r", "\n")).strip()
    return text, "sha256:" + hashlib.sha256(text.encode()).hexdigest()


@plain
def evidence_dedup(sf):
    held, out = index(sf), []
    said = {d["doc_id"]: content_id(d["text"]) for d in held.docs}
    words = {i: {t.casefold() for t in re.findall(ranking.TOKEN, text)} for i, (text, _) in said.items()}
    for q in rows(sf, "benchmark", "item_id, text"):
        kept, removed = {}, []
        for position, (_, i, _, _) in enumerate(held.search(planned(q["text"]), False, 20), 1):
            match = next(((j, "content_id") for j in kept if said[j][1] == said[i][1]), None)
            if match is None and len(words[i]) >= 12:
                match = next(((j, f"token_jaccard:{s:.4f}") for j in kept if (s := len(words[i] & words[j]) / len(words[i] | words[j])) >= 0.92), None)
            if match:
                kept[match[0]][1].append(str(i))
                removed.append({"position": position, "document_id": str(i), "kept": False, "duplicate_of": str(match[0]), "reason": match[1], "alternates": ""})
            else:
                kept[i] = (position, [])
        out += [{"query_id": q["item_id"], **r} for r in removed]
        out += [{"query_id": q["item_id"], "position": p, "document_id": str(i), "kept": True, "duplicate_of": None, "reason": None, "alternates": ",".join(a)} for i, (p, a) in kept.items()]
    return out


@plain
def route_query(sf):
    out = []
    for kind, key, column in (("benchmark", "item_id", "text"), ("pages", "page_id", "url")):
        for r in rows(sf, kind, f"{key} AS item_id, {column} AS q"):
            q = r["q"] or ""
            every = re.findall(ranking.TOKEN, q.lower())
            kept = [t for t in every if t not in ranking.STOP_WORDS] or every
            names = [m[0] for m in re.finditer(ranking.IDENTIFIER, q)]
            if '"' in q:
                said = "bm25", "an exact or phrase match is asked for"
            elif names and len(every) <= 8 and len({x.lower() for x in names}) / max(1, len(every)) >= 0.4:
                said = "bm25", "technical identifiers dominate"
            elif every and every[0] not in ranking.QUESTION_WORDS and len(every) <= 7 and len(kept) <= 5:
                said = "bm25", "a terse technical phrase"
            else:
                said = "hybrid", "concepts in natural language gain from both indexes"
            out.append({"kind": kind, "item_id": r["item_id"], "retrieval": said[0], "reason": said[1]})
    return out


BLOCKS = "p|pre|li|dt|dd|blockquote|figcaption|td|th|h[1-6]"
HIDDEN = "script|style|noscript|svg|nav|header|footer|aside|dialog"


@plain
def html_blocks(sf):
    """By cutting the text at tags: hidden parts of the made pages do not nest, and their classes are none of those that
    are skipped."""
    out = []
    for page in rows(sf, "pages", "page_id, html"):
        text = re.sub(rf"(?is)<!--.*?-->|<!doctype[^>]*>|<({HIDDEN})\b[^>]*>.*?</\1\s*>", "", page["html"] or "")
        text = re.sub(r"(?is)<title\b.*?</title>", "", text)
        parts = re.split(rf"(?i)(<(?:{BLOCKS})\b[^>]*>)", text)
        path, n = [], 0
        for tag, body in zip(parts[1::2], parts[2::2], strict=True):
            name = re.match(r"<(\w+)", tag)[1].lower()
            level, said = 0, []
            for piece in re.split(r"(<[^>]*>)", body):
                if piece.startswith("<"):
                    word = re.match(r"</?(\w+)", piece)
                    if piece.startswith("</"):
                        level -= 1
                        if level < 0:
                            break
                    elif word and word[1].lower() == "br":
                        said.append("\n")
                    elif word and word[1].lower() not in ("img", "hr", "input", "meta", "link", "wbr"):
                        level += 1
                else:
                    said.append(html.unescape(piece))
            raw = "".join(said)
            clean = "\n".join(x.rstrip() for x in raw.split("\n")).strip("\n") if name == "pre" else " ".join(raw.split())
            if name[0] == "h" and name[1:].isdigit():
                if clean := clean.removesuffix("\u00b6").strip():
                    path = [*path[: int(name[1]) - 1], clean]
            elif clean:
                out.append({"page_id": page["page_id"], "block_index": n, "kind": "code" if name == "pre" else name, "heading": " > ".join(path), "text": clean})
                n += 1
    return out


@plain
def chunk_blocks_docs(sf):
    """Paragraphs, split where they are too long, packed greedily; a short tail goes back."""
    out = []
    for d in rows(sf, "documents", "doc_id, text"):
        paragraphs, now = [], []
        for line in re.split(r"\r\n|\r|\n", d["text"] or ""):
            if line.strip():
                now.append(line)
            elif now:
                paragraphs.append(now)
                now = []
        pieces = []
        for p in [*paragraphs, now]:
            rest = " ".join(html.unescape("\n".join(p)).split())
            while len(rest) > 3200:
                cuts = [rest.rfind(m, 0, 3201) for m in ("\n\n", "\n", ". ", "; ", ", ", " ")]
                at = max([c for c in cuts if c >= 1600], default=3200)
                pieces.append(rest[:at].strip())
                rest = rest[at:].strip()
            pieces.append(rest)
        chunks, used = [], 0
        for piece in filter(None, pieces):
            if chunks and used + len(piece) + 2 <= 3200 and len(chunks[-1][-1]) < 3200:
                chunks[-1].append(piece)
                used += len(piece)
            else:
                chunks.append([piece])
                used = len(piece)
        joined = ["\n\n".join(c) for c in chunks]
        if len(joined) > 1 and len(joined[-1]) < 300 and len(joined[-2]) + 2 + len(joined[-1]) <= 3200:
            joined[-2:] = ["\n\n".join(joined[-2:])]
        out += [{"doc_id": d["doc_id"], "ordinal": k, "text": t, "character_count": len(t)} for k, t in enumerate(joined)]
    return out
