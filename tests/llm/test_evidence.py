"""Evidence of pages, languages and hosts: the fused posterior against plain arithmetic, and
documents whose labels are held out."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import langid

DOCS = "doc_id long, text string, lang string, source string"
PAGES = "doc_id long, declared string, suffix string, host string"


def plain(docs, pages):
    """``doc_id -> (language, posterior)`` by the definition, one document after the other."""
    names = sorted({lang for _, _, lang, _ in docs if lang})
    classes = [*names, "und"]
    model = {n: Counter() for n in names}
    for lang, text in {(lang, text) for _, text, lang, _ in docs if lang and text is not None}:
        model[lang].update(langid.trigram_cells(text.encode()).tolist())
    total = {n: sum(model[n].values()) for n in names}
    blank = langid.trigram_cells(b"   ")[0]

    def text_logs(text):
        cells = langid.trigram_cells((text or "").encode()).tolist()
        if not text or all(c == blank for c in cells):
            return None
        rows = [sum(math.log((model[n][c] + .5) / (total[n] + .5 * langid.CELLS)) for c in cells)
                for n in names]
        return [langid.TEXT_WEIGHT * x for x in [*rows, -math.log(langid.CELLS) * len(cells)]]

    said = defaultdict(set)
    for number, *statement in pages:
        said[number].add(tuple(statement))
    logs = {i: text_logs(text) for i, text, _, _ in docs}
    rows = []
    for i, _, _, place in docs:
        guess = classes[int(np.argmax(logs[i]))] if logs[i] else None
        rows += [(d, s, h or place, guess) for d, s, h in said.get(i, {(None, None, None)})]

    def counts(test):
        found = Counter(g for *row, g in rows if test(row))
        return [found[n] for n in names]

    def factor(at, value):
        known = [r for r in rows if r[at] is not None]
        values = len({r[at] for r in known})
        whole = counts(lambda r: r[at] is not None)
        mine = counts(lambda r: r[at] == value)
        return [math.log((n + .5) / (t + .5 * values)) for n, t in zip(mine, whole)] + [-math.log(values)]

    def shares(mine, base, strength):
        return [(n + b * strength) / (sum(mine) + strength) for n, b in zip(mine, base)]

    def prior(host, suffix):
        base = shares(counts(lambda r: True), [1 / len(names)] * len(names), len(names))
        base = shares(counts(lambda r: r[1] == suffix), base, langid.SUFFIX_STRENGTH)
        mine = shares(counts(lambda r: r[2] == host and r[1] == suffix), base, langid.HOST_STRENGTH)
        return [math.log(x * (1 - langid.UNKNOWN_PRIOR)) for x in mine] + [math.log(langid.UNKNOWN_PRIOR)]

    out = {}
    for i, _, _, place in docs:
        if logs[i] is None:
            out[i] = ("und", 0.0)
            continue
        mine = said.get(i, set())
        parts = [logs[i]]
        parts += [factor(0, d) for d in {d for d, _, _ in mine} if d is not None]
        parts += [factor(1, s) for s in {s for _, s, _ in mine} if s is not None]
        hosts = {(h, s) for _, s, h in mine if h is not None} or {(place, None)}
        parts.append(np.mean([prior(*h) for h in hosts], axis=0))
        fused = np.sum(parts, axis=0)
        at = int(np.argmax(fused))
        out[i] = (classes[at], 1 / float(np.exp(fused - fused[at]).sum()))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_fused_posterior_equals_plain_arithmetic(spark, seed):
    draw = random.Random(seed)
    words = {lang: ["".join(draw.choice(signs) for _ in range(4)) for _ in range(12)]
             for lang, signs in (("aa", "abcde"), ("bb", "bcdef"), ("cc", "cdefg"))}
    docs = [(i, " ".join(draw.choices(words[lang], k=draw.randint(1, 6))),
             lang if draw.random() < .7 else None, draw.choice(["p", "q", None]))
            for i, lang in enumerate(draw.choices(list(words), k=60))]
    docs += [(90, None, "aa", "p"), (91, "", None, "q"), (92, "12 34", "bb", None)]
    pages = [(draw.randrange(70), draw.choice(["aa", "bb", None]), draw.choice(["net", "org", None]),
              draw.choice(["x.net", "y.org", "z.org", None])) for _ in range(80)]
    pages += pages[:9]
    found = {r["doc_id"]: r for r in langid.identify(spark.createDataFrame(docs, DOCS),
                                                     spark.createDataFrame(pages, PAGES)).collect()}
    expected = plain(docs, pages)
    assert len(found) == len(docs)
    for i, (language, posterior) in expected.items():
        assert found[i]["language"] == language, i
        assert found[i]["posterior"] == pytest.approx(posterior, abs=1e-5)
        assert found[i]["kept"] == (language != "und" and posterior >= .35)


def test_a_declaration_on_any_page_counts(spark):
    docs = [(i, "the cat and the dog " * 20, "en", "h") for i in range(30)]
    docs += [(100 + i, "der hund und die katze " * 20, "de", "h") for i in range(30)]
    docs += [(200, "xy", None, "h"), (201, "xy", None, "h")]
    html = "<html lang='{}'><body></body></html>"
    rows = [(i, f"http://site.net/a/{i}", html.format("de" if i >= 100 else "en")) for i, *_ in docs[:60]]
    rows += [(300, "http://site.net/b/200", "<html></html>"), (301, "http://site.net/b/200/", html.format("de")),
             (302, "http://site.net/b/201", "<html></html>"), (303, "http://site.net/b/201?x", html.format("en"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    evidence = langid.page_evidence(pages)
    assert evidence.where("doc_id = 200").count() == 2
    found = {r["doc_id"]: r["language"] for r in langid.identify(spark.createDataFrame(docs, DOCS), evidence).collect()}
    assert found[200] == "de" and found[201] == "en"


def test_languages_of_documents_whose_labels_are_held_out(spark):
    """Every other document loses its label before the model is fitted; measured on those."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = F.col("doc_id") % 2 == 1
    blind = docs.withColumn("lang", F.when(~held, F.col("lang")))
    found = (langid.document_languages(spark, sf, blind).where(held)
             .join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null"))
    n, fused, text = found.agg(F.count(F.lit(1)), F.avg((F.col("language") == F.col("lang")).cast("int")),
                               F.avg((F.col("text_language") == F.col("lang")).cast("int"))).first()
    print(n, fused, text)
    assert n > 4000 and fused > 0.995 and text > 0.995
