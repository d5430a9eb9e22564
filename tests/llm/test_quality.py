import re

from vaultscope.llm.quality import keep_quality, quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, host string, n_words int")


def got(df):
    return [tuple(r) for r in df.orderBy("doc_id", "n_words", "word_chars").collect()]


TEXTS = [
    None, "", " \t\n ", "a b", "a b c", "a b c a b c", "x " * 60, "\n".join(["same line # here"] * 3), "é\u00a0ü \x1c z\x0by",
    " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i % 40}" for i in range(60)), "*#$%&|<>" * 3, "long " * 5000 + "tail " * 3,
]


def test_measures_against_brute_force(spark):
    rows = [(k, t, "h", "clash", 1) for k, t in enumerate(TEXTS)]
    out = got(quality_rules(table(spark, rows), limit=1.0))
    want = [(k, *brute(t)) for k, t in enumerate(TEXTS)]
    assert [r[:7] for r in out] == want
    assert [r[7] for r in out] == [not w[-1] for w in want]


GOOD = " ".join(f"word{i}" for i in range(80))


def test_host_verdicts(spark):
    rows = [(k, GOOD if k % 20 == 0 else "short", "bad.host", "c", 1) for k in range(400)]
    rows += [(1000 + k, GOOD if k % 10 else "short", f"host{k % 5}" if k % 5 else None, "c", 1) for k in range(400)]
    rows += [(2000, GOOD, "tiny", "c", 1), (2001, "short", "tiny", "c", 1), (2002, "short", "one", "c", 1)]
    df = table(spark, rows)
    kept = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules(df).collect()}
    for doc, text, host, *_ in rows:
        assert kept[doc] == (text == "short", text != "short" and host != "bad.host"), (doc, host)
    stay = keep_quality(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(d for d, (_, k) in kept.items() if k)


def test_one_failing_document_does_not_condemn_a_small_host(spark):
    rows = [(k, GOOD, f"h{k % 30}", "c", 1) for k in range(300)] + [(900, "short", "new", "c", 1), (901, GOOD, "new", "c", 1)]
    assert {r.doc_id: r.kept for r in quality_rules(table(spark, rows)).collect()}[901]


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(None, GOOD, None, "c", 1), (1, GOOD, "a", "c", 1), (1, GOOD, "a", "c", 1)]
    df = table(spark, rows)
    assert [r.kept for r in quality_rules(df).collect()] == [True] * 3
    assert keep_quality(df).count() == 3
    assert quality_rules(df.limit(0)).count() == 0 and keep_quality(df.limit(0)).count() == 0


def test_windows_with_one_hash_are_compared(spark, monkeypatch):
    """Where all windows share one hash, windows count as repeated only next to an equal one."""
    from pyspark.sql import functions as F

    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, "a a a a a")], "doc_id long, text string")
    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(0).cast("long"))
    from vaultscope.llm.quality import measures

    assert [r.n for r in df.select(measures(F.col("text")).n_repeat_words.alias("n")).collect()] == [0, 5]


def test_clashing_names(spark):
    from vaultscope.llm.quality import keep_quality

    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(70)), "a", 1, 2, 3)], "doc_id long, text string, source string, failed int, bad_host int, __host int")
    out = keep_quality(docs)
    assert out.columns == docs.columns and [tuple(r)[3:] for r in out.collect()] == [(1, 2, 3)]
