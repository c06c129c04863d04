"""Brute-force single-machine model of the pipeline rules, for tests only.

Written from the behaviour spec (SURVEY §2): plain Python ``re`` with
look-around, lists and loops, numpy for the similarity search. The Spark
operators must agree with it on small inputs.
"""

from __future__ import annotations

import itertools
import json
import re

import numpy as np

HEADER = re.compile(r"(?=^#+ )", re.M)


class Broken(Exception):
    pass


def _plain(v: str):
    if v and v[0] in "\"'":
        if len(v) < 2 or v[-1] != v[0]:
            raise Broken
        return v[1:-1]
    v = re.split(r"(?:^|\s+)#", v)[0].strip()
    if re.search(r":(\s|$)", v):
        raise Broken
    return v


def _block(style: str, rows: list[str]) -> str:
    margin = next((len(r) - len(r.lstrip(" ")) for r in rows if r.strip()), 0)
    text = "\n".join(r[margin:] for r in rows).rstrip("\n")
    if style[0] == ">":
        text = "\n".join(" ".join(part.split("\n")) for part in text.split("\n\n"))
    return text if style.endswith("-") or not text else text + "\n"


def _descend(rows: list[str]):
    """Value of some lines by recursive descent: the lines below a key or an item, cut at those of its own margin."""
    rows = [r for r in rows if r.strip() and not r.strip().startswith("#")] if not rows or not any(
        re.search(r"[|>][+-]?$", r) for r in rows) else rows
    while rows and (not rows[0].strip() or rows[0].strip().startswith("#")):
        rows = rows[1:]
    if not rows:
        return ""
    margin = len(rows[0]) - len(rows[0].lstrip(" "))
    listed = rows[0][margin:].startswith("- ")
    if not listed and not re.match(r"[A-Za-z_][^:\"']*:(\s|$)", rows[0][margin:]):
        raise Broken
    groups: list[list[str]] = []
    for r in rows:
        own = r.strip() and len(r) - len(r.lstrip(" ")) == margin
        if own and (listed or not r[margin:].startswith("- ")):
            groups.append([r])
        elif r.strip() and len(r) - len(r.lstrip(" ")) < margin:
            raise Broken
        else:
            groups[-1].append(r)
    if listed:
        return [_item(g, margin) for g in groups]
    found: dict = {}
    for head, *rest in groups:
        if not re.match(r"[A-Za-z_][^:\"']*:(\s|$)", head[margin:]):
            raise Broken
        key, _, value = head[margin:].partition(":")
        found[key.strip()] = _value(value.strip(), rest)
    return found


def _value(value: str, rest: list[str]):
    if re.fullmatch(r"[|>][+-]?", value):
        return _block(value, rest)
    if not value or value.startswith("#"):
        return _descend(rest)
    if any(re.search(r":(\s|$)", r) for r in rest):
        raise Broken
    return " ".join([_plain(value), *(_plain(r.strip()) for r in rest if r.strip())])


def _item(group: list[str], margin: int):
    inner = [" " * (margin + 2) + group[0][margin + 2:], *group[1:]]
    if re.match(r"[A-Za-z_][^:\"']*:(\s|$)|- ", group[0][margin + 2:]):
        return _descend(inner)
    return _value(group[0][margin + 2:].strip(), group[1:])


def _json(v):
    if isinstance(v, dict):
        return {k: _json(x) for k, x in v.items()}
    if isinstance(v, list):
        return [_json(x) for x in v]
    return int(v) if re.fullmatch("-?(0|[1-9][0-9]*)", v) else {"": None, "true": True, "false": False}.get(v, v)


def _shown(v) -> str:
    if isinstance(v, list) and all(isinstance(x, str) for x in v):
        return "[" + ", ".join(v) + "]"
    return v if isinstance(v, str) else json.dumps(_json(v), separators=(",", ":"), ensure_ascii=False)


def frontmatter(raw: str):
    """(metadata pairs, content, parsed_ok)."""
    if not raw.startswith("---"):
        return [], raw, True
    end = raw.find("---", 3)
    if end < 0:
        return [], raw, True
    try:
        found = _descend(raw[3:end].strip().split("\n")) or {}
        if not isinstance(found, dict):
            raise Broken
    except Broken:
        return [], raw, False
    return [(k, _shown(v)) for k, v in found.items()], raw[end + 3:].lstrip(), True


def sections(content: str) -> list[str]:
    return [p.strip() for p in HEADER.split(content) if p.strip() and "NO_CONTENT_HERE" not in p]


def title_body(sec: str, default: str = "Section"):
    m = re.match(r"#+ (.*)", sec)
    title = m.group(1).strip() if m else default
    body = sec.split("\n", 1)[1].strip() if m and "\n" in sec else ("" if m else sec)
    return title, body


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def sentences(text: str) -> list[str]:
    """Character scanner: a sentence ends where white space follows . ! or ?, but not after an abbreviation like x.y."""
    pieces, begin, i, guarded = [], 0, 0, -1
    while i < len(text):
        quad = text[i:i + 4]
        if i > guarded and len(quad) == 4 and _is_word(quad[0]) and _is_word(quad[2]) and quad[1] == quad[3] == ".":
            guarded = i + 3  # the second dot; scanning for the next abbreviation goes on behind it
        if text[i].isspace() and i > begin and text[i - 1] in ".!?" and i - 1 != guarded:
            pieces.append(text[begin:i])
            while i < len(text) and text[i].isspace():
                i += 1
            begin = i
        else:
            i += 1
    pieces.append(text[begin:])
    joined: list[str] = []
    for starts_low, run in itertools.groupby(filter(str.strip, pieces), key=lambda p: "a" <= p[0] <= "z"):
        run = list(run)
        if starts_low and joined:
            run = [" ".join([joined.pop(), *run])]
        joined += [" ".join(run)] if starts_low else run
    return joined


def _marker_length(line: str) -> int:
    """Length of a list marker and the white space behind it; 0 for any other line."""
    head = line.split(None, 1)[0] if line.strip() else ""
    if head in ("*", "-") or (head.endswith(".") and head[:-1].isdecimal()):
        rest = line[len(head):]
        return len(head) + len(rest) - len(rest.lstrip()) if rest[:1].isspace() else 0
    return 0


def list_items(par: str, link_parents: bool = False) -> list[str]:
    """Every line gets the number of the item it belongs to; item 0 stands before the first marker."""
    lines = [(ln[:1].isspace(), ln.strip()) for ln in par.split("\n") if ln.strip()]
    marks = [_marker_length(ln) for _, ln in lines]
    number = list(itertools.accumulate(int(m > 0) for m in marks))
    texts = [ln[m:] for (_, ln), m in zip(lines, marks)]
    out = []
    for item in range(1, max(number, default=0) + 1):
        mine = [i for i, n in enumerate(number) if n == item]
        text = " ".join(texts[i] for i in mine)
        if link_parents and lines[mine[0]][0]:
            above = [i for i in range(mine[0]) if marks[i] and not lines[i][0]]
            text = f"{texts[above[-1]] if above else ''} - {text}"
        out.append(text)
    return out


def facts(body: str, link_parents: bool = False) -> list[str]:
    """Paragraphs are what blank lines separate; each is a list or prose by its first line."""
    blocks = [[]]
    for ln in body.split("\n"):
        if ln.strip():
            blocks[-1].append(ln)
        else:
            blocks.append([])
    whole = ["\n".join(b).strip() for b in blocks if b]
    found = [x for p in whole for x in (list_items(p, link_parents) if _marker_length(p) else sentences(p))]
    long = [x.strip() for x in found if len(x.strip()) > 10]
    return long or ([body.strip()] if body.strip() else [])


def image_refs(text: str) -> list[str]:
    return re.findall(r"\{\{([^}]+)\}\}", text)


def tokens(text: str) -> list[str]:
    return re.findall(r"\b\w\w+\b", text.lower())


def knn(secs: list[str], queries: list[str], self_idx: list[int], stop: set[str],
        k: int = 3, max_chars: int | None = None, max_terms: int | None = None) -> list[list[tuple[int, float]]]:
    """TF-IDF cosine kNN of each query over the sections (1-based result indices)."""
    n = len(secs)
    kk = min(k, n - 1)
    if kk <= 0:
        return [[] for _ in queries]
    docs = [[t for t in tokens(s[:max_chars]) if t not in stop] for s in secs]
    cf: dict[str, int] = {}
    for d in docs:
        for t in d:
            cf[t] = cf.get(t, 0) + 1
    vocab = sorted(cf, key=lambda t: (-cf[t], t))[:max_terms]
    col = {t: i for i, t in enumerate(vocab)}
    dfreq = np.zeros(len(vocab))
    for d in docs:
        for t in set(d):
            if t in col:
                dfreq[col[t]] += 1
    idf = np.log((1 + n) / (1 + dfreq)) + 1

    def vec(ts):
        v = np.zeros(len(vocab))
        for t in ts:
            if t in col:
                v[col[t]] += 1
        v *= idf
        nrm = np.linalg.norm(v)
        return v / nrm if nrm else v

    c = np.array([vec(d) for d in docs]) if vocab else np.zeros((n, 0))
    res = []
    for q, own in zip(queries, self_idx):
        qv = vec(tokens(q)) if vocab else np.zeros(0)
        sims = np.round(c @ qv, 6) if vocab else np.zeros(n)
        order = sorted(range(n), key=lambda j: (-sims[j], j))[:kk]
        res.append([(j + 1, float(sims[j])) for j in order if j + 1 != own])
    return res
