"""Template labels and scores against every alignment, on texts with several notices."""

from __future__ import annotations

from collections import Counter

from tests.llm import brute
from tidecast.llm import licenses

PAIRS = [(5, 6), (0, 5), (0, 6), (11, 10), (4, 9), (7, 8)]
FILL = "we hereby state that any copy granted in binary form is charge free "


def notices():
    texts = [" ".join(words for _, words, _ in licenses.TEMPLATES)]
    texts += [f"{licenses.TEMPLATES[a][1]} and then {licenses.TEMPLATES[b][1]}" for a, b in PAIRS]
    texts += [FILL * 3 + t + " " + FILL for _, t, _ in licenses.TEMPLATES]
    texts += [" ".join(t.split()[2:]) for _, t, _ in licenses.TEMPLATES]
    return texts + [*(k for _, _, keys in licenses.TEMPLATES for k in keys), FILL, "plain words", "", None] + ["other"] * 60


def expected(docs):
    words = {d: brute.ALNUM.findall(brute.lower(t)) for d, t in docs}
    holding = Counter(w for _, t in docs for w in set(brute.ALNUM.findall(brute.lower(t))))
    out = {}
    for d, ws in words.items():
        text, labels, score = f" {' '.join(ws)} ", set(brute.licence(" ".join(ws))[4].split(",")) - {""}, 0.0
        score = 1.0 if labels else 0.0
        for label, template, keys in licenses.TEMPLATES:
            if not any(f" {k} " in text for k in keys):
                continue
            want = template.split()
            weight = [licenses._idf(len(docs), holding[w]) for w in want]
            share = max(sum(x for p, (w, x) in enumerate(zip(want, weight)) if 0 <= s + p < len(ws) and ws[s + p] == w)
                        for s in range(-len(want), len(ws))) / sum(weight)
            score = max(score, share)
            if share >= licenses.THRESHOLD:
                labels.add(label)
        out[d] = (",".join(sorted(labels)), round(score, 9))
    return out


def test_texts_with_several_notices(spark):
    docs = list(enumerate(notices()))
    rows = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in rows}
    assert got == expected(docs)
    assert set(got[0][0].split(",")) >= {label for label, _, _ in licenses.TEMPLATES}
    for n, (a, b) in enumerate(PAIRS, 1):
        assert {licenses.TEMPLATES[a][0], licenses.TEMPLATES[b][0]} <= set(got[n][0].split(","))


def test_rows_that_share_id_and_text_score_once(spark):
    text = "software under cc by nc"
    docs = [(1, text), (1, text), *[(n, "other") for n in range(2, 40)]]
    rows = licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).where("doc_id = 1").collect()
    assert [(r["labels"], round(r["score"], 9)) for r in rows] == [expected(docs)[1]] * 2
