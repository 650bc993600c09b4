"""The operators made of Spark expressions: mixing, rules, chats, licences."""

import re
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from placeloom.llm import chat, licenses, mixing, queries, rules

BLANK = " \t\n\x0b\f\r"


def words(text):
    out, now = [], ""
    for c in text or "":
        if c in BLANK:
            out, now = (out + [now], "") if now else (out, "")
        else:
            now += c
    return out + [now] * bool(now)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def brute_measures(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), sum(a == b for a, b in zip(w, w[1:]))


def test_measures(spark, sf, awkward, nothing):
    extra = spark.createDataFrame([(-1, "a a a a a a a"), (-2, "a b c d e f a b c d e"), (-3, "x\nx\n\n \nx y\r\nx y\r"), (-4, "1 2 3 4 5 1 2 3 4 5 6 1 2 3 4 5"), (-5, "a\x1cb\x85c\xa0d")], "doc_id long, text string")
    for docs in (spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(extra), awkward.select("doc_id", "text")):
        got = Counter(tuple(r)[1:] for r in rules.measures(docs).collect())
        assert got == Counter(brute_measures(r.text) for r in docs.collect())
    assert no_python(rules.measures(awkward))
    assert rules.judged(rules.measures(nothing), []).count() == 0


def test_rules_hold_on_labels_not_learnt_from(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    measured = rules.measures(docs).where(~rules.base_failed()).cache()
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)) == 0
    learnt = queries.learnt_rules(measured, labels.where(half))
    r = rules.judged(measured, learnt).join(labels.where(~half), "doc_id").agg(F.count_if(F.expr("quality = 1 and kept")).alias("good_kept"), F.count_if(F.expr("quality = 1")).alias("good"), F.count_if(F.expr("quality = 0 and not kept")).alias("bad_gone"), F.count_if(F.expr("quality = 0")).alias("bad")).first()
    print(*map(str, learnt), r)
    assert learnt
    assert r.good_kept >= 0.995 * r.good
    assert r.bad_gone >= 0.9 * r.bad


def test_a_rare_kind_of_bad_text_is_learnt(spark):
    """Good texts stutter now and then, more often than an octile tells; 2 in 100 are nothing but stutter."""
    n = 3000
    stutter = lambda i: 60 + i % 7 if i % 50 == 0 else i % 10 if i % 3 == 0 else 0
    rows = [(i, 100 + i % 97, 500 + i % 89, i % 5, 0, 0, stutter(i)) for i in range(n)]
    measured = spark.createDataFrame(rows, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_stutters long")
    labels = spark.createDataFrame([(i, int(i % 50 != 0)) for i in range(n)], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in rules.judged(measured, queries.learnt_rules(measured, labels)).collect()}
    assert not any(kept[i] for i in range(0, n, 50))
    assert all(kept[i] for i in range(n) if i % 50)


def test_a_failing_rule_is_set_aside():
    """Most bad rows lie where three times as many good ones do; ten lie alone, found only after that rule failed."""
    counts = [((1, 0), held, 90, 270) for held in (False, True)] + [((0, 1), held, 10, 0) for held in (False, True)] + [((0, 0), held, 0, 2000) for held in (False, True)]
    learnt = rules.learn({"a": [0.5], "b": [0.5]}, counts)
    assert [str(c) for c in learnt[0]] == ["b > 0.5"] and len(learnt) == 1


def test_rules_without_labels(spark, awkward):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert queries.learnt_rules(rules.measures(awkward), labels) == []


def test_mix_meets_its_targets(spark, sf, awkward, nothing):
    rows = queries.op2_mixing(spark, sf).collect()
    texts = {r.doc_id: (r.source, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    taken, target = Counter(), {}
    for r in rows:
        source, text = texts[r.doc_id]
        assert r.size == len(words(text))
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
        target[source] = r.target
    total, sizes = sum(r.size for r in rows), {texts[r.doc_id][0]: r.source_size for r in rows}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    want, free, left = {}, set(sizes), 1.5 * total
    while True:  # what is above its most is held there, the rest shared again
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        want |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    want |= {s: weight[s] * level for s in free}
    longest = max(r.size for r in rows)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= longest / 2 + 1
    assert mixing.plan(awkward).count() == 10
    assert mixing.plan(nothing).count() == 0
    assert no_python(mixing.plan(awkward))
    assert mixing.mixed(awkward).columns == awkward.columns


def test_schedules_are_inverted(spark):
    for k, knots in enumerate(mixing.SCHEDULES):
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
        rows = spark.range(101).select((F.col("id") / 100).alias("x")).select("x", mixing.training_time(F.col("x"), F.lit(k)).alias("t")).collect()
        for r in rows:
            done = 0.0
            for (t, w), (u, v) in zip(knots, knots[1:]):
                end = min(max(r.t, t), u)
                done += (end - t) * (2 * w + (v - w) * (end - t) / (u - t)) / 2 / area
            assert done == pytest.approx(r.x, abs=1e-9)


def test_chats_come_back(spark):
    rows = [
        (1, 0, "user", "hi ~0 <|end|>\n ~1"), (1, 1, "user", "<|next|><|start|>x\ny"), (1, 2, "assistant", "</s>[INST]"), (1, 2, "assistant", "~~2"), (1, 4, None, None), (1, 5, "assistant", ""),
        (2, None, "a\n~n<|", "t"), (2, 1, "assistant", "\n"), (None, 3, "assistant", "no id"),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn int, role string, text string, turns string")
    chats = chat.format_chats(df)
    assert no_python(chat.summary(chats))
    got = {r.conv_id: r for r in chats.withColumn("back", chat.parse_chats(F.col("formatted"))).collect()}
    for conv in (1, 2, None):
        mine = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        assert [(b.role, b.text) for b in got[conv].back] == [(b, c) for _, b, c in mine]
        at, learnt = 0, ""
        for run in got[conv]["mask"]:
            learnt += got[conv].formatted[at : at + run.n_chars] if run.loss else ""
            at += run.n_chars
        assert at == len(got[conv].formatted)
        for k, x in [*enumerate(chat.CONTROL, 1)]:
            assert x not in learnt
            learnt = learnt.replace(f"~{k}", x)
        assert learnt.replace("~0", "~") == "".join(c for _, b, c in mine if b == "assistant")
    assert chat.summary(chat.format_chats(df.limit(0))).count() == 0


def brute_found(text, best_only=False):
    """(gain, first, last, dice, name) over the whole text, the pieces with an anchor, and all windows of pieces that begin at, or just before, one that notices begin with."""
    found, anchors = [], set(licenses.anchors())
    words = lambda x: re.sub(r"[^\w]|_", " ", x.lower()).split()
    pieces = re.split(r"\n|(?<=[.;:!?])[ \t]+", text or "")
    hinted = [bool(anchors & set(words(x))) for x in pieces]
    begins = [any(w.startswith(licenses.STARTS) for w in words(x)) for x in pieces]
    if not any(hinted):
        return []
    windows = [(0, len(pieces) - 1, text)] + [(i, i, x) for i, x in enumerate(pieces) if hinted[i]]
    for i in range(len(pieces)):
        if begins[i] or begins[i + 1 : i + 2] == [True]:
            windows += [(i, i + k - 1, " ".join(pieces[i : i + k])) for k in licenses.WINDOWS if i + k <= len(pieces)]
    for first, last, passage in windows:
        a, w = set(licenses._bigrams(passage)), set(words(passage))
        versions = {g for g in a if re.fullmatch(licenses.VERSION, g)}
        for name, t in licenses.TEMPLATES:
            b = set(licenses._bigrams(t))
            if not a or 2 * len(a & b) / (len(a) + len(b)) < licenses.DICE:
                continue
            if best_only:
                needed, barred, own = licenses.telling(t)
                odd = {v for v in versions - own if any(re.fullmatch(r"\d \d", o) for o in own) or not re.fullmatch(r"\d 0", v)}
                if needed - w or barred & w or own and odd:
                    continue
            found.append((2 * len(a & b) - (len(a) + len(b)) / 2, first, last, 2 * len(a & b) / (len(a) + len(b)), name))
    return found


def brute_notices(text):
    best = {}
    for *_, dice, name in brute_found(text):
        best[name] = max(best.get(name, 0), round(dice, 6))
    return best


def brute_best(text):
    """Of passages that overlap the one of the greatest gain, equal ones of other names too."""
    kept = []
    for gain, first, last, dice, name in sorted(brute_found(text, True), reverse=True):
        if not any(f <= last and first <= t and (g > gain or n == name) for g, f, t, _, n in kept):
            kept.append((gain, first, last, dice, name))
    best = {}
    for *_, dice, name in kept:
        best[name] = max(best.get(name, 0), round(dice, 6))
    return best


def test_licences(spark, sf, awkward, nothing):
    extra = spark.createDataFrame([(-1, licenses.TEMPLATES[1][1]), (-2, "x\nreleased under the mit licence!\ny"), (-3, "Released under the MIT License."), (-4, "the license of a poet")], "doc_id long, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(extra)
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert {x.name: round(x.dice, 6) for x in r.notices} == brute_notices(texts[r.doc_id])
    for r in licenses.scan(docs, best_only=True).collect():
        assert {x.name: round(x.dice, 6) for x in r.notices} == brute_best(texts[r.doc_id])
    assert no_python(licenses.scan(awkward))
    assert licenses.summary(licenses.scan(awkward)).count() == 10
    assert licenses.summary(licenses.scan(nothing)).count() == 0


def test_a_passage_has_its_nearest_licence_only(spark):
    wrapped = lambda t, n, mark="": "\n".join(mark + x for x in textwrap.wrap(t, n))
    header = next(x for n, x in licenses.TEMPLATES if n == "GPL-3.0" and "redistribute" in x)
    texts = {
        "a\nThis work is licensed under the GNU General Public License, version 3.\nb": "GPL-3.0",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        header.replace("version 3", "version 2"): "GPL-2.0",
        header: "GPL-3.0",
        header.replace("version 3", "version 1"): "",
        licenses._REDISTRIBUTION: "BSD-2-Clause",
        licenses._REDISTRIBUTION + licenses._ENDORSE: "BSD-3-Clause",
        # whole licences and headers, wrapped, behind comment marks, beside code; and inside a longer line
        wrapped(f"Copyright (c) 2020 A. Name {licenses._REDISTRIBUTION}{licenses._ENDORSE} {licenses._BSD_DISCLAIMER}", 60): "BSD-3-Clause",
        wrapped(f"{licenses._REDISTRIBUTION} {licenses._BSD_DISCLAIMER}", 75): "BSD-2-Clause",
        "import os\n" + wrapped(licenses._APACHE_HEADER, 70, "# ") + "\ndef f(x):\n    return x": "Apache-2.0",
        "int x;\n" + wrapped(f"{licenses._PERMISSION} {licenses._AS_IS}", 80, " * ") + "\nint main() {\n  return 0;\n}": "MIT",
        "import os\n// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in compliance with the License.\n// You may obtain a copy at http://www.apache.org/licenses/LICENSE-2.0\nrun()": "Apache-2.0",
        "Some prose comes first. This work is licensed under the GNU General Public License, version 3. More prose follows it here.": "GPL-3.0",
        wrapped(f"{licenses._ISC} {licenses._ISC_DISCLAIMER}", 72): "ISC",
        wrapped(licenses._ZLIB, 72): "Zlib",
        "Released under the MIT License.\nLicensed under CC BY 4.0.": "CC-BY-4.0,MIT",
        # siblings, as they are usually written
        "This work is licensed under the GNU General Public License, version 2.0 or later.": "GPL-2.0",
        header.replace("General", "Affero General"): "AGPL-3.0",
        header.replace("General", "Lesser General"): "LGPL-3.0",
        header.replace("General", "Lesser General").replace("version 3", "version 2.1").replace("program", "library"): "LGPL-2.1",
        wrapped(header.replace("General", "Lesser General").replace("version 3", "version 2.1").replace("software:", "software;"), 64, "# "): "LGPL-2.1",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
        "This work is licensed under the Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
    }
    # each template is itself, alone and wrapped
    texts |= {x: n for n, x in licenses.TEMPLATES} | {"int x;\n" + wrapped(x, 72, "// ") + "\nrun();": n for n, x in licenses.TEMPLATES}
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = licenses.scan(docs, best_only=True)
    assert no_python(found)
    assert [r.licences for r in licenses.summary(found).orderBy("doc_id").collect()] == [*texts.values()]


def test_rules_query_is_what_the_learnt_list_says(spark):
    """base_failed by brute force; kept by the learnt conditions read in Python; labels that the list gets right."""
    sf = "/root/testdata/sf0.01"
    rows = queries.op3_quality_rules(spark, sf).collect()
    measured = rules.measures(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    learnt = queries.learnt_rules(measured, labels)
    for r in rows:
        per = lambda x, k: x * k / r.n_words if r.n_words else 0.0
        scaled = {"words": r.n_words, "word_length": per(r.word_chars, 1), "symbols": per(r.n_symbols, 100), "same_lines": per(r.n_dup_lines, 100), "repeated": per(r.n_repeat_words, 100), "stutters": per(r.n_stutters, 100)}
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        rejected = any(all((scaled[c.measure] > c.threshold) == c.above for c in rule) for rule in learnt)
        assert r.kept == (not r.base_failed and not rejected)
    quality = {r.doc_id: r.quality for r in labels.collect()}
    judged = [r.kept == bool(quality[r.doc_id]) for r in rows if quality.get(r.doc_id) is not None]
    assert sum(judged) >= 0.9 * len(judged)


def test_few_vectors_come_to_the_driver(spark, monkeypatch):
    """Every labelled row that the base rules let pass is counted in one of them."""
    sf = "/root/testdata/sf0.01"
    measured, labels = rules.measures(spark.read.parquet(f"{sf}/documents.parquet")), spark.read.parquet(f"{sf}/labels.parquet")
    every = rules.statistics(measured, labels)[1]
    monkeypatch.setattr(rules, "VECTORS", 30)
    thresholds, few = rules.statistics(measured, labels)
    assert len(few) <= 30 < len(every)
    assert sum(r[2] + r[3] for r in few) == sum(r[2] + r[3] for r in every)
    assert isinstance(rules.learn(thresholds, few), list)


def test_measures_with_clashing_names(spark, awkward):
    assert rules.measures(awkward.withColumn("_trim", F.lit(1)), keep=("_text", "_trim", "node")).columns[:4] == ["doc_id", "_text", "_trim", "node"]
    with pytest.raises(ValueError, match="n_words"):
        rules.measures(awkward.withColumn("n_words", F.lit(1)), keep=("n_words",))


def test_the_mix_changes_over_training(spark, sf):
    """The fading source's share of the first third is larger than of the last; that of the growing one smaller."""
    mix = mixing.plan(spark.read.parquet(f"{sf}/documents.parquet"), keep=("source",))
    rows = mix.select(F.col("_keep.source").alias("source"), "size", F.explode("positions").alias("p")).collect()
    names = sorted({r.source for r in rows})
    share = lambda s, low, high: sum(r.size for r in rows if r.source == s and low <= r.p < high) / max(1, sum(r.size for r in rows if low <= r.p < high))
    assert share(names[0], 0, 1 / 3) > share(names[0], 2 / 3, 1.01)
    assert share(names[2], 0, 1 / 3) < share(names[2], 2 / 3, 1.01)
    assert all(0 <= r.p <= 1 for r in rows)
