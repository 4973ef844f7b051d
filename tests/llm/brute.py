"""Plain versions of the operators, for small tables."""

import re
import zlib
from collections import Counter

import numpy as np

GAP = "\x20\x09-\x0d"


def words(text):
    return re.findall(f"[^{GAP}]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(docs):
    """docs: {id: text}; the smallest id reachable over similarity of 0.75."""
    sets = {k: shingles(t) for k, t in docs.items()}
    root = {k: k for k in docs}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {k: find(k) for k in ids}


def repeats(raws, mode, length=200):
    """raws: {id: bytes}; the bytes that stay."""
    count, first = Counter(), {}
    for d in sorted(raws):
        for i in range(len(raws[d]) - length + 1):
            s = raws[d][i : i + length]
            count[s] += 1
            first.setdefault(s, (d, i))
    out = {}
    for d, raw in raws.items():
        keep = np.ones(len(raw), bool)
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if count[s] > 1 and (mode == "all" or first[s] != (d, i)):
                keep[i : i + length] = False
        out[d] = bytes(b for b, k in zip(raw, keep, strict=True) if k)
    return out


def common_subsequence(a, b):
    """Pairs (i, j) of a longest common subsequence, by the table of all prefixes."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def line_dedup(docs, least=5):
    """Of {id: text} the texts without runs of aligned lines that hold a line of ``least`` words, over all pairs of a document and an earlier one."""
    lines = {k: v.split("\n") for k, v in docs.items()}
    gone = {k: set() for k in docs}
    for k, mine in lines.items():
        for other in sorted(x for x in lines if x < k):
            shared = {x for x in mine if len(words(x)) >= least}.intersection(lines[other])
            if not shared:
                continue
            run, last = [], (-2, -2)
            for i, j in [*common_subsequence(lines[other], mine), (-9, -9)]:
                if (i, j) != (last[0] + 1, last[1] + 1):
                    if any(mine[x] in shared for x in run):
                        gone[k].update(run)
                    run = []
                run.append(j)
                last = (i, j)
            gone[k].update(j for j, x in enumerate(mine) if x in shared)
    return {k: "\n".join(x for j, x in enumerate(v) if j not in gone[k]) for k, v in lines.items()}


def measures(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall("[#*$%&|<>]", text or "")), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


def top(rows, k, every, scale=64):
    """rows: (id, vector)."""
    fine = [(i, np.floor(scale * np.asarray(v, float)).astype(np.int64)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, q in fine:
        if i % every == 0:
            got = sorted((-int(q @ v), j) for j, v in fine if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(got)]
    return sorted(out)


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
