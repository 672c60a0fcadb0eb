from __future__ import annotations

import re

import pytest

from tallyhouse.llm import line_templates, mixing, quality
import brute


def corpus(prose):
    texts = [prose(1, 90 + 7 * i, 3) for i in range(30)] + ["short text of few words only"]
    texts += [re.sub(r"(\S+)", r"\1%%%", prose(2, 120)), prose(3, 100).upper(), "word " * 90, "a b c d e f g\n" * 3 + prose(4, 70)]
    return [{"doc_id": i, "text": t, "lang": "xy", "source": f"s{i % 5}", "n_chars": len(t)} for i, t in enumerate(texts)]


def same(found, expected, *names):
    def rows(values):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in (r[n] for n in names)) for r in values)

    assert rows(found) == rows(expected)


def test_quality_rules_equal_sql(spark, prose):
    docs = corpus(prose)
    found = quality.judged(spark.createDataFrame(docs)).select("doc.doc_id", "*").collect()
    expected = brute.sql("op10_quality_rules", docs)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    same(found, expected, *names)
    assert {r.doc_id: r.kept for r in found} == {r["doc_id"]: r["kept"] for r in expected}


def test_quality_of_odd_rows(odd):
    rows = quality.judged(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if (r.n_words or 0) < 10)
    long = next(r for r in rows if r.n_words == 30_000)
    assert long.n_repeat_words == 0 and not long.base_failed
    assert quality.judged(odd.limit(0)).count() == 0
    assert quality.accepted(odd).columns == odd.columns


@pytest.mark.parametrize("text, words", [
    ("a b c d e a b c d e", 10), ("a b c d e f", 0), ("a a a a a a", 6), ("a b c d e x a b c d e y", 10), ("a b c d", 0),
    ("a b c d e", 0), ("a b c d e a b c d e a b c d e", 15),
])
def test_repeated_words(spark, text, words):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(text,)], "t string").select(quality.repeated_words(F.split("t", " "), 5).alias("n")).first()
    assert row.n == words


def test_references_shuffle_their_words_once(spark, prose):
    plan = quality.references(spark.createDataFrame(corpus(prose)))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"hashpartitioning\(lang#\d+, word#\d+", plan)) == 1


def test_repeats_are_found_outside_functions_of_elements(spark, prose):
    plan = quality.judged(spark.createDataFrame(corpus(prose)))._jdf.queryExecution().optimizedPlan().toString()
    keys = next(line for line in plan.splitlines() if "array_distinct(repeats" in line)
    assert "lambda" not in keys


def test_references_of_languages_without_words(spark, docs):
    rows = {r.ref_lang: r for r in quality.references(docs((1, "", "xx", "s"), (2, None, None, "s"), (3, "\t\u00a0 A9.\n#", "yy", "s"))).collect()}
    assert rows["xx"].ref_words == rows[None].ref_words == 0 and rows["xx"].common is None and rows[None].word_share is None
    assert rows["xx"].class_share == [0.0] * 5
    # A no-break space is no white space here, but part of a word and of the class of other characters.
    assert rows["yy"].class_share == pytest.approx([n / 8 for n in (1, 1, 3, 1, 2)])
    assert rows["yy"].ref_words == 3 and rows["yy"].common == ["#", "a9.", "\u00a0"]


def test_distance_of_equal_and_disjoint_histograms(spark):
    row = spark.sql("select array(2, 2) a, array(0.5D, 0.5D) b, array(4, 0) c, array(0.0D, 1.0D) d").select(
        quality.distance(*columns("a", "b")).alias("same"),
        quality.distance(*columns("c", "d")).alias("far"),
    ).first()
    assert row.same == pytest.approx(0) and row.far == pytest.approx(1)


def columns(*names):
    from pyspark.sql import functions as F

    return [F.col(n) for n in names]


def test_lines_equal_sql(spark, prose):
    passage = prose(50, 60)
    docs = [{
        "doc_id": i, "text": f"{prose(i, 40, 2)}\nPage {i} of 77 at {i}:30\n" + ("Click here to log in\n" if i % 2 else "") + (passage if i in (3, 8) else "x"),
        "lang": "en", "source": "s", "n_chars": 1,
    } for i in range(24)]
    found = line_templates.cleaned(spark.createDataFrame(docs)).select("doc.doc_id", "text", "n_lines", "n_dropped").collect()
    same(found, brute.sql("op2_line_templates", docs), "doc_id", "text", "n_lines", "n_dropped")
    texts = {r.doc_id: r.text for r in found}
    assert "Page 0 of" in texts[0] and not any("Page" in texts[i] for i in range(1, 24))  # numbers are fields
    assert passage in texts[3] and passage not in texts[8]
    assert sum("Click" in t for t in texts.values()) == 1


def test_words_that_vary_are_fields(spark, docs, prose):
    texts = [f"{prose(i, 30)}\nNew user today is {name} and we say welcome" for i, name in enumerate("abcdefghijklmn")]
    found = line_templates.cleaned(docs(*texts)).select("doc.doc_id", "text", "n_dropped").collect()
    assert sorted(r.n_dropped for r in found) == [0] + [1] * 13


def cleaned(spark, texts):
    docs = [{"doc_id": i, "text": t, "lang": "en", "source": "s", "n_chars": len(t)} for i, t in enumerate(texts)]
    found = line_templates.cleaned(spark.createDataFrame(docs)).select("doc.doc_id", "text", "n_lines", "n_dropped").collect()
    same(found, brute.sql("op2_line_templates", docs), "doc_id", "text", "n_lines", "n_dropped")
    return {r.doc_id: r.text for r in found}


def test_passages_of_several_lines(spark, prose):
    passage = "\n".join(["", prose(900, 20), prose(901, 20), "", "ok", prose(902, 20), prose(903, 5)])
    short = f"{prose(904, 20)}\n{prose(905, 20)}"
    texts = [prose(i, 60, 3) for i in range(12)]
    texts[2] += passage
    texts[7] = texts[7] + passage + "\n" + prose(99, 30)
    texts[4], texts[9] = f"{texts[4]}\n{short}", f"{texts[9]}\n{short}"
    found = cleaned(spark, texts)
    assert passage in found[2] and not any(prose(s, n) in found[7] for s, n in ((900, 20), (901, 20), (902, 20), (903, 5)))
    assert found[7].endswith(prose(99, 30)) and "\nok" in found[7]
    assert short in found[4] and short in found[9]  # no more than 40 words recur
    assert all(found[i] == texts[i] for i in range(12) if i != 7)


def test_lines_that_recur_apart_are_no_passage(spark, prose):
    first, second = prose(910, 30), prose(911, 30)
    texts = [f"{first}\n{prose(i, 40)}\n{second}" if i % 2 else f"{second}\n{prose(i, 40)}\n{first}" for i in range(8)]
    assert cleaned(spark, texts) == dict(enumerate(texts))


def test_an_equal_long_line_goes_whatever_its_leaf(spark, prose):
    def line(seed):
        return "Read all about it " + prose(seed, 60)

    texts = [f"{prose(i, 30)}\n{line(1000 + i // 2)}" for i in range(20)]
    found = cleaned(spark, texts)
    assert all((line(1000 + i // 2) in found[i]) == (i % 2 == 0) for i in range(20))


def test_templates_do_not_hang_on_the_size_of_the_corpus(spark, prose):
    """Each value of a varying word is on many lines; the template still is one."""
    texts = [f"{prose(i, 30)}\nNew user today is {'abc'[i % 3] * 3} and {'xyz'[i // 3 % 3] * 3} says welcome" for i in range(90)]
    found = cleaned(spark, texts)
    assert sum("New user today" in t for t in found.values()) == 1


def test_lines_of_odd_rows(odd):
    rows = line_templates.cleaned(odd).select("doc.*", "n_lines", "n_dropped").collect()
    assert len(rows) == odd.count() and {r.n_dropped for r in rows} == {0}
    assert next(r.n_lines for r in rows if r.doc_id is None) == 0
    assert line_templates.without_recurring(odd).columns == odd.columns
    assert line_templates.cleaned(odd.limit(0)).count() == 0


def test_documents_of_recurring_lines_only_are_gone(docs):
    found = line_templates.without_recurring(docs(*["All rights are reserved here"] * 12, "another line stands alone"))
    assert sorted(r.doc_id for r in found.collect()) == [0, 12]


def mix(docs):
    return mixing.mixed(mixing.measured(docs))


def test_mixing_equals_sql(spark, prose):
    docs = [{"doc_id": i, "text": prose(i, 20 + i % 50), "lang": "en", "source": None if i % 9 == 8 else f"s{i * i % 7}", "n_chars": 0} for i in range(150)]
    found = [r.asDict() | {"taken": r.repeats * r.size + r.part} for r in mix(spark.createDataFrame(docs)).select("doc.doc_id", "*").collect()]
    same(found, brute.sql("op9_source_mixing", docs), "doc_id", "size", "source_size", "target", "taken")
    for rows in brute.grouped(found, "source").values():
        assert sum(r["taken"] for r in rows) == int(rows[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)


def test_repeated_rows_hold_the_taken_words(spark, docs, prose):
    table = docs(*[(i, prose(i, 30, 4), "en", f"s{i % 4}") for i in range(40)])
    rows = mix(table)
    taken = {r.id: r.n for r in rows.selectExpr("doc.doc_id id", "repeats * size + part n").collect()}
    repeated = mixing.repeated(rows)
    assert repeated.columns == table.columns
    counted: dict[int, int] = {}
    for r in repeated.collect():
        counted[r.doc_id] = counted.get(r.doc_id, 0) + len(brute.WORD.findall(r.text))
        assert prose(r.doc_id, 30, 4).startswith(r.text) and r.n_chars == len(r.text)
    assert counted == {k: v for k, v in taken.items() if v}


def test_mixing_of_odd_rows(odd):
    rows = mix(odd).select("doc.doc_id", "source", "size", "source_size", "target").collect()
    assert len(rows) == odd.count()
    assert {r.source: r.source_size for r in rows} == {"s": 30_006, "t": 3, None: 6}
    assert all(r.target <= 2 * r.source_size for r in rows)
    assert mix(odd.limit(0)).count() == 0
    assert mixing.repeated(mix(odd)).columns == odd.columns


def test_a_source_without_words_takes_nothing(docs):
    rows = mix(docs((1, "", "en", "a"), (2, "x y z", "en", "b"))).collect()
    assert {r.source: r.target for r in rows} == {"a": 0.0, "b": 4.5}


def test_a_text_is_cut_once_and_not_sorted(docs):
    plan = line_templates.without_recurring(docs("one line", "another"))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("array_except") == 1
    assert "ShuffledHashJoin" in plan.executedPlan().toString()
