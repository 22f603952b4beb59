import odd

from lotkeeper.llm import licences
from lotkeeper.llm.known_licences import KNOWN

MIT = next(t for n, t in KNOWN if n == "MIT" and t.startswith("Permission"))


def names(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [tuple(r)[1:] for r in licences.scan(frame).orderBy("doc_id").collect()]


def test_whole_texts_in_other_dress(spark):
    other = "Copyright (c) 2019 Some One\n\n" + MIT.lower().replace('"', "'").replace("\n\n", "\n  ").replace("copyright holders", "copyright owners")
    found = names(spark, [MIT, other, MIT + " And more.", MIT[:-20], "(C) Me 2020\nMIT Licence\n\n" + MIT.replace("sublicense", "sub-license")])
    assert [f[0] for f in found] == ["MIT", "MIT", None, None, "MIT"]


def test_lines_and_their_names(spark):
    text = odd.sentences(1, 5)
    found = names(spark, [f"{text}\nReleased under the MIT License.\n{text}\n  licensed under the apache licence, version 2.0",
                          "Licensed under CC BY-NC 4.0.", text, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.", None, ""])
    assert found == [(None, 2, "Apache-2.0,MIT"), ("CC-BY-NC-4.0", 0, "CC-BY-NC-4.0"), (None, 0, None),
                     (None, 2, "CC-BY-NC-4.0"), (None, 0, None), (None, 0, None)]


def test_odd_rows_and_empty_table(spark):
    assert licences.scan(odd.documents(spark).unionByName(odd.documents(spark))).count() == 2 * len(odd.rows())
    assert licences.scan(odd.empty(spark)).count() == 0


def test_long_licences_and_notice_wordings(spark):
    whole = {n: t for n, t in KNOWN if len(t) > 1_000 and n in (
        "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "Unlicense")}
    assert len(whole) == 8
    notices = {"Licensed under the GNU General Public License, version 2.": "GPL-2.0", "This work is licensed under CC BY 4.0.": "CC-BY-4.0",
               "Released under the BSD License.": "BSD"}
    assert [f[0] for f in names(spark, [*whole.values(), *notices])] == [*whole, *notices.values()]


def test_known_texts_from_a_table(spark):
    known = spark.createDataFrame([("House", "Use it as you like."), ("Long", odd.words(1, 3_000)), (None, "x"), ("x", None), ("y", "")],
                                  "licence string, text string")
    docs = spark.createDataFrame([(1, "use it as you like"), (2, odd.words(1, 3_000)), (3, MIT), (4, "")], "doc_id long, text string")
    assert [r["text_licence"] for r in licences.scan(docs, known=known).orderBy("doc_id").collect()] == ["House", "Long", None, None]
    assert licences.scan(docs, known=known.limit(0)).where("licences is not null").count() == 0
