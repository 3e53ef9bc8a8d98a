"""Plain Python versions of the operators, written from their contracts."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import xxhash

WS = re.compile(r"[\x20\x09-\x0D]")


def exact_dedup(docs):
    groups = defaultdict(list)
    for i, t in docs:
        t = t or ""
        groups[WS.sub("", t)].append((-len(t), i))
    out = []
    for norm, rows in groups.items():
        keep = min(rows)[1]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(rows), i == keep, sha) for _, i in rows]
    return sorted(out)


def quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    n, r = len(words), len(hit)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def secrets(text):
    text = text or ""
    key = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token"))
    key += "|[aA][pP][iI]_?[kK][eE][yY]"
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    kinds = Counter(k for _, _, k, _ in found)
    text = ",".join(f"{k}:{s}:{e}" for s, _, k, e in found)
    return kinds["assign"], kinds["access"], kinds["hex"], hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def components(ids, fps):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    least = {}
    for x in range(len(ids)):
        least[root(x)] = min(ids[x], least.get(root(x), ids[x]))
    return [least[root(x)] for x in range(len(ids))]


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def cut(ids, most=2048):
    first = len(ids) % most
    out, at = [], 0
    for n in ([first] if first else []) + [most] * (len(ids) // most):
        out.append((at, n, crc(ids[at : at + n])))
        at += n
    return out


def chats(rows, schemas, segment_turns=256, segment_rows=1024):
    """(conv_id, segment, piece) to the counts and the messages as objects; no two rows of a conversation may tie."""
    import json

    def parsed(role, text):
        try:
            body = json.loads(text) if role in ("assistant", "tool") else None
        except (ValueError, RecursionError):
            body = None
        return body if isinstance(body, dict) else None

    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role or "", text or ""))
    out = {}
    for conv, talk in talks.items():
        talk.sort(key=lambda m: -math.inf if m[0] is None else m[0])
        call_of, answered, placed = {}, set(), []
        for turn, role, text in talk:
            body = parsed(role, text)
            if role == "assistant" and body and "tool_calls" in body:
                for c in body["tool_calls"]:
                    call_of.setdefault(c["id"], turn)
        seen = set()
        for turn, role, text in talk:
            n = dict.fromkeys(("n_calls", "n_valid_calls", "n_duplicate_calls", "n_linked", "n_orphans", "n_repeated"), 0)
            body, place = parsed(role, text), (turn, 0)
            message = {"content": text, "role": role}
            if role == "tool" and body and "tool_call_id" in body:
                message, of = {"content": None, **body, "role": role}, body["tool_call_id"]
                if of not in call_of:
                    n["n_orphans"] = 1
                else:
                    n["n_repeated" if of in answered else "n_linked"] = 1
                    answered.add(of)
                    if call_of[of] > turn:
                        place = (call_of[of], 1)
            elif role == "assistant" and body and "tool_calls" in body:
                message = {"content": None, **body, "role": role, "tool_calls": []}
                for c in body["tool_calls"]:
                    arguments, good = c.get("arguments", {}), c["name"] in schemas
                    if isinstance(arguments, str):
                        try:
                            arguments = json.loads(arguments)
                        except ValueError:
                            good = False
                    good = good and fits(arguments, schemas[c["name"]])
                    message["tool_calls"].append({**c, "arguments": arguments})
                    n["n_calls"] += 1
                    n["n_valid_calls"] += good
                    n["n_duplicate_calls"] += c["id"] in seen
                    seen.add(c["id"])
            placed.append((place, turn, n, message))
        placed.sort(key=lambda p: (p[0], p[1]))
        segments = defaultdict(list)
        for p in placed:
            segments[p[0][0] // segment_turns].append(p)
        for segment, own in segments.items():
            for at in range(0, len(own), segment_rows):
                part = own[at : at + segment_rows]
                counts = Counter()
                for _, _, n, _ in part:
                    counts.update(n)
                out[conv, segment, at // segment_rows] = (len(part), dict(counts), [m for *_, m in part])
    return out


def fits(value, schema):
    """For objects of strings and whole numbers."""
    if not isinstance(value, dict) or set(schema["required"]) - value.keys() or value.keys() - schema["properties"].keys():
        return False
    for k, v in value.items():
        s = schema["properties"][k]
        if s["type"] == "string" and not (isinstance(v, str) and len(v) >= s.get("minLength", 0)):
            return False
        if s["type"] == "integer" and not (type(v) is int and s["minimum"] <= v <= s["maximum"]):
            return False
    return True
