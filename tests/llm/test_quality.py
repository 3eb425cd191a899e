import random
import re

import pytest
from conftest import SF_SMALL
from cdclake.llm.quality import clean_documents, with_quality

RNG = random.Random(5)
PROSE = [" ".join(f"word{RNG.randrange(9999)}" for _ in range(15)) + ", and so on." for _ in range(12)]


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in with_quality(docs).collect():
        q, (n, chars, symbols, lines, repeated) = r["quality"], base(texts[r["doc_id"]])
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == (n, chars, symbols, lines, repeated)
        assert q["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and not (q["kept"] and q["base_failed"])


def test_edge_cases_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (4, "a b a b a b", "x"), (5, "é  ü w\n\né  ü w", "x"), (6, "a b c " * 3000, "x"), (6, "a b c " * 3000, "x"), (None, "a b c a b c", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, __q string")
    df = df.withColumnRenamed("__q", "quality0").withColumnRenamed("quality0", "n_words")
    got = with_quality(df).collect()
    assert len(got) == len(rows)
    for r in got:
        q = r["quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"]) == base(r["text"])
        assert not q["kept"]
    assert with_quality(df.limit(0)).count() == 0


def test_lines_that_fail_go_and_documents_that_lose_too_much(spark):
    good = "\n".join(PROSE)
    bad = ["Home | News | Sport | Login | Help | More", "All rights reserved.", "We use Cookies.", "no sentence end", "### *** $$$ &&& %%%."]
    rows = [(1, good, 0), (2, "\n".join([good, *bad, PROSE[3]]), 0), (3, "\n".join([PROSE[1]] + [f"menu {i} | home {i} | sport {i} | login {i}" for i in range(40)]), 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int")
    out = {r["doc_id"]: r for r in clean_documents(df).collect()}
    assert set(out) == {1, 2} and out[1]["text"] == good and out[2]["text"] == good
    assert out[2]["n_chars"] == len(good) and clean_documents(df).columns == df.columns


def test_padded_lines_end_sentences_too(spark):
    pads = ["    ", "\t\t\t\t\t", '.")\r   ', "\"')]»", " " * 500]
    rows = [(k, "\n".join(x + pad for x in PROSE)) for k, pad in enumerate(pads)] + [(99, "no end" + " " * 9)]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r["quality"] for r in with_quality(df, min_words=1).collect()}
    assert all(got[k]["kept"] and got[k]["n_failed_lines"] == 0 and got[k]["clean_text"] == text for k, text in rows[:-1])
    assert got[99]["n_failed_lines"] == 1 and not got[99]["kept"]


def test_a_column_named_quality_stays(spark):
    text = "\n".join(PROSE)
    docs = spark.createDataFrame([(1, text, 7)], "doc_id long, text string, quality int")
    assert [tuple(r) for r in clean_documents(docs).collect()] == [(1, text, 7)]
    with pytest.raises(ValueError):
        with_quality(docs)
    assert with_quality(docs, column="judged").select("quality", "judged.kept").first() == (7, True)


def test_furniture_of_four_languages_goes_and_paragraphs_that_speak_of_it_stay(spark):
    furniture = ["Alle Rechte vorbehalten.", "Wir verwenden Cookies.", "Tous droits réservés.", "Conditions d'utilisation :", "Haz clic aquí.", "Política de Privacidad.", "Please enable JavaScript!", "We use cookies."]
    prose = ["She baked a cookie for the guests.", "He wrote the first JavaScript engine.", "Critics said that the privacy policy of the firm, " + "which nobody had read, " * 9 + "was far too long."]
    text = "\n".join([*PROSE, *furniture, *prose])
    assert len(prose[2]) > 200
    q = with_quality(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()["quality"]
    assert q["n_failed_lines"] == len(furniture) and q["clean_text"] == "\n".join([*PROSE, *prose]) and q["kept"]
