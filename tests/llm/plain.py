"""Plain Python statements of what the queries must give, for comparison on small tables."""

from __future__ import annotations

import re
from collections import defaultdict
from urllib.parse import unquote

import pyarrow.parquet as pq


def rows(folder, name):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def key(p):
    if p is None:
        return None
    p = re.sub(r"/+", "/", unquote(p).replace("\\", "/").strip().lower())
    p = [x for x in p.split("/") if x != "."]
    return "/".join(p[-3:]) or None


def label(x):
    x = (x or "").strip().lower()
    for k, n in (("0", "recyclable"), ("1", "electronic"), ("2", "organic")):
        if x in (n, f"{k}_{n}"):
            return k
    try:
        f = float(x)
    except ValueError:
        return None
    return str(int(f)) if f in (0, 1, 2) else None


def entity(path):
    m = re.match(r"(?:thumb_|copy of )?[reo][_.-](?:\d{8}_)?([a-z]{2}\d\d)[_.-]?(?:obj)?0*(\d+)", path.split("/")[-1].lower())
    return f"{m[1]}-{m[2]}" if m else None


def spelled(folder):
    return {key(r["path"]): r["path"] for r in rows(folder, "image_audit")}


def latest(folder):
    out = {}
    for r in rows(folder, "image_audit"):
        k = key(r["path"])
        if k not in out or r["audited_at"] >= out[k]["audited_at"]:
            out[k] = r
    return out


def components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    groups = defaultdict(set)
    for x in up:
        groups[find(x)].add(x)
    return list(groups.values())


def p1(folder):
    at = spelled(folder)
    by = defaultdict(set)
    for r in rows(folder, "manifest_clean"):
        p = at.get(key(r["path"]))
        if p and entity(p):
            by[entity(p)].add(p)
    return {(p, e) for e, ps in by.items() if len(ps) > 1 for p in ps}


def p2(folder):
    at = spelled(folder)
    edges = []
    for t in ("near_duplicate_pairs", "dedup_group_pairs"):
        edges += [(at.get(key(r["path_a"])), at.get(key(r["path_b"]))) for r in rows(folder, t)]
    for r in rows(folder, "exact_duplicates"):
        ps = [at[k] for k in map(key, (r["paths"] or "").split("|")) if k in at]
        edges += list(zip(ps, ps[1:]))
    return {(p, min(g)) for g in components([(a, b) for a, b in edges if a and b and a != b]) for p in g}


def positive(x):
    x = re.sub(r"\s*px$", "", (x or "").strip().lower())
    if re.fullmatch(r"\d{1,3}(,\d{3})+", x):
        x = x.replace(",", "")
    try:
        v = float(x)
    except ValueError:
        return None
    return v if 0 < v < float("inf") else None


def source(x):
    x = (x or "").strip().lower().replace("-", "")
    return x if re.fullmatch(r"[a-z]{2}\d\d", x) else None


def p3(folder):
    last = latest(folder)
    at = {k: r["path"] for k, r in last.items()}
    edges = [(at.get(key(r["keep_path"])), at.get(key(r["remove_path"]))) for r in rows(folder, "duplicate_review_actions")]
    by_path = {r["path"]: r for r in last.values()}
    out = set()
    for g in components([(a, b) for a, b in edges if a and b and a != b]):
        ms = [by_path[p] for p in g]
        best = lambda xs: max(xs)[-1] if xs else None
        sized = [(positive(m["width"]) * positive(m["height"]), m["audited_at"], m["path"]) for m in ms if not (m["error"] or "").strip() and positive(m["width"]) and positive(m["height"])]
        picks = {"size": best(sized), "label": best([(m["audited_at"], m["path"]) for m in ms if label(m["current_label"])]), "source": best([(m["audited_at"], m["path"]) for m in ms if source(m["capture_source"])])}
        out |= {(min(g), f, p) for f, p in picks.items() if p}
    return out


def digest(x):
    m = re.fullmatch(r"(?:sha256[:=-])?([0-9a-f]{64})", (x or "").strip().lower())
    return m and m[1]


def p4(folder):
    last = latest(folder)
    splits = defaultdict(set)
    for r in rows(folder, "embedding_manifest"):
        m = re.search(r"(train|val|test)_manifest\.", (r["source_manifest"] or "").lower())
        if m and key(r["path"]) in last:
            splits[key(r["path"])].add(m[1])
    ev = {k for k, s in splits.items() if s & {"val", "test"}}
    tr = {k for k, s in splits.items() if "train" in s}
    out = {(k, k) for k in ev & tr}
    for r in rows(folder, "near_duplicate_pairs"):
        a, b = key(r["path_a"]), key(r["path_b"])
        if a != b and ((a in ev and b in tr) or (a in tr and b in ev)):
            out.add((a, b))
    by = defaultdict(set)
    for k in ev | tr:
        d = digest(last[k]["sha256"])
        if d and not (last[k]["error"] or "").strip():
            by[d].add(k)
    for g in by.values():
        out |= {(a, b) for a in g & ev for b in g & tr if a != b}
    name = lambda k: last[k]["path"]
    return {tuple(sorted((name(a), name(b)))) for a, b in out}


def p6(folder):
    have = defaultdict(set)
    known = spelled(folder)
    for r in rows(folder, "manifest_clean"):
        if key(r["path"]) in known and label(r["current_label"]):
            have[label(r["current_label"])].add(key(r["path"]))
    return {(r["request_id"], r["label"]) for r in rows(folder, "sample_targets") if max(round(r["target_share"] * r["sample_size"]), r["min_rows"]) > len(have[r["label"]])}


def vectors(folder):
    """Rows and unit vectors of the valid rows, and the image of each row."""
    import numpy as np

    image = {}
    for r in rows(folder, "embedding_manifest"):
        m = re.fullmatch(r"(\d+)(?:\.0*)?", (r["embedding_row"] or "").strip())
        if m and (r["valid_embedding"] or "").strip().lower() in ("1", "1.0", "true"):
            image[int(m[1])] = key(r["path"])
    out = {}
    for r in rows(folder, "image_vectors"):
        v = np.array([np.nan if x is None else x for x in r["embedding"] or []], float)
        if r["embedding_row"] in image and len(v) == 64 and np.isfinite(v).all() and v.any():
            out[r["embedding_row"]] = v / np.linalg.norm(v)
    ids = sorted(out)
    return np.array(ids), np.array([out[i] for i in ids]).reshape(-1, 64), image


def p7(folder, k=5, least=0.92):
    import numpy as np

    ids, x, _ = vectors(folder)
    cases = set()
    for at in range(0, len(x), 1000):
        s = x[at : at + 1000] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -9
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        for i in range(len(s)):
            cases |= {tuple(sorted((int(ids[at + i]), int(ids[b])))) for b in top[i] if s[i, b] >= least}
    return cases
