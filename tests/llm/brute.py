"""Plain versions of the operators, one row or all pairs at a time."""

import hashlib
import math
import re
import statistics
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
STRIP = " \t\n\v\f\r"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# html ----------------------------------------------------------------------


def framed_texts(pages, page_blocks, flow, share):
    """{page_id: text} of unmarked pages: template tokens by explicit occurrence vectors per host."""
    hosts = defaultdict(list)
    for i, url, page in pages:
        hosts[url.split("/")[2]].append((i, page_blocks(page)))
    out = {}
    for rows in hosts.values():
        vectors = defaultdict(lambda: [0] * len(rows))
        where = defaultdict(list)
        for n, (_, blocks) in enumerate(rows):
            for place, b in enumerate(blocks):
                vectors[b.path, b.text][n] += 1
                where[b.path, b.text].append(place)
        classes = defaultdict(list)
        for t, v in vectors.items():
            present = sum(1 for x in v if x)
            if present >= share * len(rows):
                classes[tuple(v)].append((sum(where[t]) / present, t))
        template = {t: v for v, ts in classes.items() for _, t in ts}
        for n, (i, blocks) in enumerate(rows):
            at = defaultdict(list)
            for place, b in enumerate(blocks):
                at[b.path, b.text].append(place)
            valid = set()
            for v, ts in classes.items():
                once = sum(v) == sum(1 for x in v if x)
                places = [at[t] for _, t in sorted(ts, key=lambda x: x[0])]
                if all(places) and (not once or (all(len(p) == 1 for p in places) and places == sorted(places))):
                    valid.add(v)
            while True:  # classes nest: every token lies in a valid class or outside all elements
                up = {
                    v for v in valid
                    if all(not p or template.get((p, None)) in valid
                           for _, (path, text) in classes[v] for p in [path if text is not None else path.rpartition("/")[0]])
                }
                if up == valid:
                    break
                valid = up
            texts = [(k, b) for k, b in enumerate(blocks) if b.text is not None and not b.dropped]
            slots = [k for k, b in texts if template.get((b.path, b.text)) not in valid]
            inside = texts
            if slots:
                element = blocks[slots[0]].element
                while element.parent and (element.name in flow or not all(element.start <= k < element.end for k in slots)):
                    element = element.parent
                inside = [(k, b) for k, b in texts if element.start <= k < element.end]
            out[i] = " ".join(b.text for _, b in inside)
    return out


# secret scan ---------------------------------------------------------------

ASSIGN = re.compile(
    r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"""
    r"""[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def base_spans(text):
    text = text or ""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6
    ]
    for order, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        found += [(m.start(), order, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    found.sort()
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in found)


def entropy(run):
    return -sum(c / len(run) * math.log2(c / len(run)) for c in Counter(run).values())


def hot_windows(run, window, bits):
    covered = set()
    for i in range(len(run) - window + 1):
        if entropy(run[i : i + window]) >= bits - 1e-9:
            covered.update(range(i, i + window))
    spans = []
    for i in sorted(covered):
        if spans and spans[-1][1] == i:
            spans[-1][1] = i + 1
        else:
            spans.append([i, i + 1])
    return [tuple(s) for s in spans]


# decontamination -----------------------------------------------------------


def windows(text, size=10):
    w = FOLDED.findall(lower(text))
    return [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []


def contamination(text, items):
    words = FOLDED.findall(lower(text))
    hit, ids = set(), set()
    for item, phrase in items:
        for win in windows(phrase):
            for p in range(len(words) - len(win) + 1):
                if tuple(words[p : p + len(win)]) == win:
                    hit.update(range(p, p + len(win)))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


def near_items(text, items, slop):
    words = FOLDED.findall(lower(text))
    places = defaultdict(set)
    for p, w in enumerate(words):
        places[w].add(p)
    near = set()
    for item, phrase in items:
        for win in windows(phrase):
            for s in range(-slop, len(words) + slop):
                if all(
                    any(s + k + d in places[w] for d in range(-slop, slop + 1)) for k, w in enumerate(win)
                ):
                    near.add(str(item))
                    break
    return sorted(near)


# SimHash -------------------------------------------------------------------


def fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def simhash_components(rows):
    prints = [(i, fingerprint(t)) for i, t in rows]
    links = [
        (a, b)
        for n, (a, f) in enumerate(prints)
        for b, g in prints[n + 1 :]
        if (f ^ g).bit_count() <= 4
    ]
    return dict(prints), components([i for i, _ in prints], links)


# quality -------------------------------------------------------------------


def statistics_of(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {g for g, c in Counter(grams).items() if c > 1}
    repeated = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(ch in "#*$%&|<>" for w in words for ch in w),
        "n_lines": len(lines),
        "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(repeated),
    }


def quality(rows):
    """Verdicts of (key, text, lang, source) rows by the operator's parameters, one group at a time."""
    from meterlens.llm import quality_rules as q

    def vector(s):
        n = max(s["n_words"], 1)
        values = (
            math.log(n),
            s["word_chars"] / n,
            math.sqrt(s["n_symbols"] / n),
            s["n_dup_lines"] / max(s["n_lines"], 1),
            s["n_repeat_words"] / n,
        )
        return [math.floor(v * q.UNIT + 0.5) / q.UNIT for v in values]

    least = np.array([f[1] for f in q.FEATURES.values()])
    high = np.array([f[2] == "high" for f in q.FEATURES.values()])
    stats = {}
    groups = defaultdict(list)
    for key, text, lang, source in rows:
        s = statistics_of(text)
        s["base_failed"] = s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"]
        stats[key] = (s, lang, source)
        if not s["base_failed"]:
            for group in ((lang, source), (lang,), ()):
                groups[group].append(vector(s))

    def distances(x, center, precision):
        d = x - center
        d = np.where(high & (d < 0), 0, d)
        return np.maximum(np.einsum("ni,ij,nj->n", d, precision, d), 0)

    def estimate(near):
        cov = np.cov(near.T, bias=True).reshape(len(least), -1) * q.CONSISTENCY
        variance = np.maximum(np.diag(cov), least**2)
        cov *= 1 - q.SHRINK
        cov[np.diag_indices(len(least))] = variance
        return near.mean(axis=0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1]

    fits = {}
    for group, x in groups.items():
        x = np.array(x)
        coarse = np.minimum(np.floor(np.round(x * q.UNIT) / (q.UNIT // q.START_BINS)), q.START_CLIP * q.START_BINS)
        center = np.array([statistics.median(c) for c in coarse.T]) / q.START_BINS
        best = None
        for center, precision in ((center, np.diag(1 / least**2)), estimate(x)[:2]):
            for _ in range(q.MAX_STEPS):  # a run that stands still stays there
                d = distances(x, center, precision)
                bins = np.floor(np.log2(d + 1e-6) * q.BINS_PER_OCTAVE)
                before = {b: (bins < b).sum() for b in set(bins)}
                near = x[[before[b] < len(x) * q.SUPPORT for b in bins]]
                center, precision, log_det = estimate(near)
                if best is None or round(log_det, 9) < round(best[0], 9):
                    best = log_det, center, precision
        fits[group] = (len(x), *best[1:])
    out = {}
    for key, (s, lang, source) in stats.items():
        d2 = None
        if not s["base_failed"]:
            for group in ((lang, source), (lang,), ()):
                n, center, precision = fits[group]
                if n >= q.MIN_GROUP or group == ():
                    d2 = distances(np.array([vector(s)]), center, precision)[0]
                    break
        out[key] = (s, d2, d2 is not None and d2 <= q.CUTOFF)
    return out


# line dedup ----------------------------------------------------------------


def line_dedup(rows):
    """{row number: (lines, dropped, kept text)} of (doc_id, text) rows."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(STRIP))
            if len(key) >= 20 and doc is not None:
                holders[key].add(doc)
    out = {}
    for n, (doc, text) in enumerate(rows):
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            docs = holders.get(lower(line.strip(STRIP)), ())
            if doc is None or len(docs) < 3 or doc == max(docs):
                kept.append(line)
        out[n] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out
