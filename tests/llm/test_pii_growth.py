"""The bootstrap of personal data against a plain version, on contexts that recur."""

import re
from collections import Counter, defaultdict

from tidemark.llm import pii


def corpus():
    known = [f"+1 617 555 01{i:02d}" for i in range(12)]
    new = [f"617-555-02{i:02d}" for i in range(10)]
    rows = [f"you may call {k} today or not" for k in known]
    rows += [f"you may call {k} today or not" for k in new]
    # no base entity stands here: only what the first context brings in
    rows += [f"the desk answers {k} always" for k in new]
    rows += [f"the desk answers {k} always" for k in ("617-555-0301", "617-555-0302")]
    # numbers of another shape, and of the shape in a context of no seeds
    rows += [f"it weighed {i} pounds" for i in range(30)]
    rows += [f"serial number 900-800-7{i:03d} shipped" for i in range(10)]
    rows += ["mail a@b.org 617-555-0999 at noon", "nothing here", "", None]
    return rows


def shaped(kind, text):
    n = len(re.sub("[^0-9]", "", text))
    if kind == 0:
        return "@" in text
    if kind == 1:
        return bool(re.search(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", text))
    return "@" not in text and (12 if kind == 2 else 7) <= n <= (19 if kind == 2 else 15)


def plain(rows, settings):
    """Spans that the bootstrap adds, as (row, start, end, kind)."""
    places = []
    for i, text in enumerate(rows):
        text = text or ""
        bases = [(m.start(), m.end(), 3) for m in re.finditer(r"\+1 [0-9]{3} [0-9]{3} [0-9]{4}", text)]
        bases += [(m.start(), m.end(), 0) for m in re.finditer(r"\S+@\S+", text)]
        units = bases + [
            (m.start(), m.end(), None)
            for m in re.finditer(r"\S*[0-9]\S*", text)
            if not any(s < m.end() and m.start() < e for s, e, _ in bases)
        ]
        spans = [(s, e) for s, e, _ in units]
        for s, e, seed in units:
            cut = max([b for a, b in spans if b <= s], default=0)
            till = min([a for a, b in spans if a >= e], default=len(text))
            left, right = text[cut:s].split()[-2:], text[e:till].split()[:1]
            contexts = [("<", *left)] if len(left) == 2 else []
            contexts += [("<>", left[-1], right[0])] if left and right else []
            places.append((i, s, e, text[s:e].lower(), seed, contexts))
    n, total = Counter(), Counter()
    for *_, word, seed, contexts in places:
        for c in contexts:
            n[c, word, seed] += 1
            total[c] += 1
    w = {(word, seed): 1.0 for _, word, seed in n if seed is not None}
    for step in range(settings.rounds + 1):
        mass, seeds = defaultdict(float), Counter()
        for (c, word, seed), k in n.items():
            for kind in range(4) if seed is None else [seed]:
                weight = w.get((word, kind), 0)
                if weight:
                    mass[c, kind] += k * weight
                    seeds[c, kind] += weight >= settings.min_score
        score = {p: m / (total[p[0]] + settings.alpha) for p, m in mass.items()}
        for c, word, seed in n:
            for kind in range(4):
                if seed is None and shaped(kind, word) and step < settings.rounds:
                    best = [v for (c2, k2), v in score.items() if k2 == kind and (c2, word, None) in n]
                    w[word, kind] = max(best, default=0)
    good = {p: v for p, v in score.items() if round(v, 9) >= settings.min_score and seeds[p] >= settings.min_seeds}
    out = set()
    for i, s, e, word, seed, contexts in places:
        best = [(good[c, k], -k) for c in contexts for k in range(4) if (c, k) in good and shaped(k, word)]
        if seed is None and best:
            out.add((i, s, e, -max(best)[1]))
    return out


def test_bootstrap_equals_the_plain_version(spark):
    rows = corpus()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got, base = set(), 0
    for r in pii.with_spans(pii.scan(docs)).collect():
        base += len(r.base)
        got |= {(r.doc_id, s.start, s.end, s.rank) for s in r.spans} - {(r.doc_id, s.start, s.end, s.rank) for s in r.base}
    assert got == plain(rows, pii.Settings()) and base == 13
    found = {rows[i][s:e] for i, s, e, _ in got}
    # the second context is learned from instances that the first one brought in
    assert {"617-555-0200", "617-555-0301", "617-555-0302"} <= found
    assert not any(x.startswith("900") for x in found) and len(got) == 22


def test_one_round_brings_less(spark):
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id long, text string")
    few = pii.with_spans(pii.scan(docs), pii.Settings(rounds=0)).selectExpr("sum(size(spans) - size(base))").first()[0]
    assert few == 0


def test_digits_behind_a_base_match_are_candidates(spark):
    docs = spark.createDataFrame([(1, "at 1.2.3.4 555-123-4567 now a@b.org 12 34")], "doc_id long, text string")
    instances = {r.instance: r.seed for r in pii.occurrences(pii.scan(docs)).collect()}
    assert instances == {"1.2.3.4": 1, "555-123-4567": None, "a@b.org": 0, "12 34": None}


def test_masks_keep_places(spark):
    docs = spark.createDataFrame([(1, "x 4111 1111 1111 1111, 1.2.3.4y é a@b.org")], "doc_id long, text string")
    row = docs.select("text", pii.masked(docs.text, pii.base_spans(docs.text)).alias("m")).first()
    assert len(row.m) == len(row.text) and row.m == "x @@@@@@@@@@@@@@@@@@@, @@@@@@@y é @@@@@@@"
