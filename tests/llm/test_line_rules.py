import re
from collections import Counter

import odd

from lotkeeper.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    found = WORD.findall(text or "")
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(found), sum(map(len, found)), sum(c in line_rules.SYMBOLS for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_figures_against_brute_force(spark):
    texts = [r[1] for r in odd.rows()] + ["a b c a b c a b", "x\nx\n\n \nx y\n", "a a a a a", "#$ <|> % word", "b c d"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in line_rules.quality(frame).collect():
        n, chars, symbols, dups, repeats = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == (n, chars, symbols, dups, repeats), texts[r["doc_id"]]
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n)


def test_lines_are_judged_one_by_one(spark):
    good = [odd.words(i, 12).capitalize() + "." for i in range(8)]
    bad = ["Home | News | Sport | Contact", "BUY NOW!! BEST PRICES!! TODAY!!", "no end to this line of words",
           "We use cookies to improve this site.", "a&&& b%%% c### d$$$."]
    text = "\n".join([good[0], bad[0], *good[1:5], *bad[1:], "", *good[5:]])
    frame = spark.createDataFrame([(1, text), (2, "\n".join(good[:2] + bad + [odd.words(90 + i, 9) for i in range(6)])), (3, "\n".join(good))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in line_rules.quality(frame, max_loss=40).collect()}
    assert found[1]["clean_text"] == "\n".join([*good[:5], "", *good[5:]]) and found[1]["kept"]
    assert not found[2]["kept"] and not found[2]["base_failed"]
    assert found[3]["lost_chars"] == 0 and found[3]["kept"] and found[3]["clean_text"] == "\n".join(good)


def test_odd_rows_and_empty_table(spark):
    found = line_rules.quality(odd.documents(spark)).collect()
    assert len(found) == len(odd.rows())
    assert all(r["base_failed"] and not r["kept"] for r in found if r["n_words"] < 50)
    assert line_rules.quality(odd.empty(spark)).count() == 0


def test_a_long_line_of_capitals_is_quick(spark):
    text = " ".join(["WORD"] * 3000) + " end"
    assert line_rules.quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["lost_chars"] > 0
