"""Cases in which an operator once did less than its whole job."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from martwright.llm import (  # noqa: E402
    embedding_e8,
    isolation_rules,
    license_rules,
    simhash_golay,
    substring_debruijn,
)
from martwright.llm.queries import QUERIES  # noqa: E402
from shared import checkpoint_folder  # noqa: E402, F401


def test_backoff_query_scores_by_other_documents(spark, tmp_path):
    """A copy is known in full; what only one document says backs off."""
    texts = ["a b c d", "a b c d", "a b e", "f g h i j", "k", ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    found = {r.doc_id: r for r in QUERIES["op6_backoff_lm"](spark, str(tmp_path)).collect()}
    assert [(found[i].n_full, found[i].n_unseen) for i in range(6)] == [(2, 0), (2, 0), (0, 1), (0, 5), (0, 1), (0, 0)]
    # Of the 13 words beside it, two are a and b each; e backs off twice and is unknown.
    logs = [np.log(2 / 14), np.log(2 / 2), np.log(0.4**3 / 15)]
    assert found[2].mean_log_score == pytest.approx(np.mean(logs), abs=1e-6)
    assert found[0].mean_log_score == pytest.approx(np.mean(np.log([2 / 13, 1, 1 / 2, 1])), abs=1e-6)
    assert found[5].mean_log_score is None


def _wrapped(sentence, width=60):
    lines, line = [], ""
    for word in sentence.split(" "):
        if line and len(line) + len(word) >= width:
            lines.append(line)
            line = word
        else:
            line = f"{line} {word}".strip()
    return [*lines, line]


# First line, comment mark, line between paragraphs, last line, line end.
FORMS = [
    ("/*", " * ", " *", " */", "\n"), ("#!", "# ", "#", "", "\n"), ("", "// ", "//", "", "\r\n"),
    ("", "", "   ", "", "\n"), ("", "", "", "", "\r\n"), ("/*", " * ", " *\t", " */", "\r\n"),
    ("", "", "", "", "\n"),
]


def test_wrapped_headers_of_every_rule(spark):
    """A copyright line, a paragraph end and the wrapped sentences, in comments or CRLF."""
    rows = []
    for first, mark, blank, last, end in FORMS:
        for name, keys in license_rules.RULES:
            body = [line for k in keys for line in [*_wrapped(license_rules.SENTENCES[k]), None]]
            lines = ["Copyright (c) 2020 x", None, *body]
            shown = [first, *(blank if x is None else mark + x for x in lines), last, "import x"]
            rows.append((len(rows), end.join(shown), name))
    found = license_rules.scan(spark.createDataFrame(rows, "doc_id long, text string, name string"))
    assert {r.doc_id: list(r.licences) for r in found.collect()} == {i: [name] for i, _, name in rows}



def _bsd(third):
    said = [license_rules.SENTENCES[k] for k in ("bsd-grant", "bsd-source", "bsd-binary")]
    return "\n".join([said[0], f"1. {said[1]}", f"2. {said[2]}", *([f"3. {third}"] if third else [])])


LICENCE_TEXTS = [
    (_bsd("Neither the name of Example GmbH & Co. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."), ["BSD-3-Clause"]),
    (_bsd("The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."), ["BSD-3-Clause"]),
    (_bsd("You shall not use our marks to endorse or promote products, ever."), ["BSD-variant"]),
    (_bsd("All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by X."), ["BSD-4-Clause"]),
    (_bsd(None), ["BSD-2-Clause"]),
    ("/* SPDX-License-Identifier: MIT OR Apache-2.0 */", ["Apache-2.0", "MIT"]),
    ("# SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0-only"]),
    ("// SPDX-License-Identifier: BSD-3-Clause\r\nint x;", ["BSD-3-Clause"]),
    ("SPDX-License-Identifier: (GPL-2.0-or-later WITH Classpath-exception-2.0) AND (MIT OR ISC)", ["GPL-2.0-or-later", "ISC", "MIT"]),
    ("SPDX-License-Identifier: LicenseRef-Own AND Zlib", ["Zlib"]),
    ("SPDX-License-Identifier: MIT or else\nwe use Apache-2.0 OR nothing", []),
    (" ".join(license_rules.SENTENCES[k] for k in ("mit-grant", "mit-notice", "mit-as-is")) + " IN NO EVENT SHALL EXAMPLE INC. OR ITS HEIRS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", ["MIT"]),
    (None, []),
    (" ".join(["a sentence."] * 30_000) + "\nSPDX-License-Identifier: MIT", ["MIT"]),
]


def test_names_clauses_and_expressions_in_licences_as_in_sql(spark, tmp_path):
    """Also rows with equal and null ids; the SQL says the same."""
    import duckdb

    from martwright.llm.oracles import oracle_sql

    rows = [(i, text) for i, (text, _) in enumerate(LICENCE_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    mine = QUERIES["op1_license_rules"](spark, str(tmp_path)).collect()
    assert {r.doc_id: r.licences for r in mine} == {i: ",".join(n) for i, (_, n) in enumerate(LICENCE_TEXTS)}
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    theirs = connection.execute(oracle_sql()["op1_license_rules"]).fetchall()
    assert sorted(map(tuple, mine)) == sorted(theirs)
    twice = docs.union(spark.createDataFrame([(0, "SPDX-License-Identifier: MIT"), (None, rows[5][1]), (None, "x")], docs.schema))
    found = sorted((str(r.doc_id), list(r.licences)) for r in license_rules.scan(twice).filter("doc_id is null or doc_id = 0").collect())
    assert found == [("0", ["BSD-3-Clause"]), ("0", ["MIT"]), ("None", []), ("None", ["Apache-2.0", "MIT"])]


def test_forest_finds_junk_by_lines_and_word_length(spark):
    """Junk without symbols or marks: a line said again and again, encoded words."""
    rng = random.Random(4)
    vocabulary = ["w" * rng.randint(2, 8) + str(i) for i in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(60, 200)))) for i in range(600)]
    rows += [(1000 + i, "\n".join(f"{w}\nshare" for w in rng.sample(vocabulary, 80))) for i in range(20)]
    rows += [(2000 + i, " ".join(rng.choice(vocabulary) * 9 for _ in range(80))) for i in range(20)]
    stats = isolation_rules.measured(spark.createDataFrame(rows, "doc_id long, text string"))
    marked = [(i, int(i < 1000)) for i, _ in rows if i % 2 == 0]
    labels = spark.createDataFrame(marked, "doc_id long, quality int")
    judged = isolation_rules.judge(stats, isolation_rules.fit(stats, labels)).collect()
    assert not any(r.base_failed for r in judged)
    assert not any(r.kept for r in judged if r.doc_id >= 1000)
    assert sum(r.kept for r in judged if r.doc_id < 1000) >= 590


def test_ids_that_different_vectors_share_lose_no_link(spark):
    """Rows of vec_id 1 with two vectors: each links with the near copies of its own."""
    rng = np.random.default_rng(8)
    first, second = rng.normal(size=(2, 24))
    near = lambda v: (v + 0.001 * rng.normal(size=24)).tolist()
    rows = [(1, first.tolist(), 0), (1, second.tolist(), 0), (1, second.tolist(), 0)]
    rows += [(10 + k, near(first), 0) for k in range(3)] + [(20 + k, near(second), 0) for k in range(2)]
    # A third of all rows alike.
    rows += [(100 + k, first.tolist(), 0) for k in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sorted(tuple(r) for r in embedding_e8.near_duplicates(df).collect())
    ones, twos = 3 + 5, 2 + 1
    assert found == sorted(
        [(1, ones, 1), (1, twos, 1), (1, twos, 1)]
        + [(10 + k, ones, 1) for k in range(3)] + [(20 + k, twos, 1) for k in range(2)]
        + [(100 + k, ones, 1) for k in range(5)]
    )


def test_ids_that_different_texts_share_lose_no_document(spark):
    """Of each component one row stays, whatever ids its rows have."""
    rng = random.Random(9)
    text = lambda: " ".join(rng.choices([f"w{i}" for i in range(500)], k=80))
    mine, other, third = text(), text(), text()
    rows = [(1, mine, "x"), (1, other, "y"), (1, other, "z"), (2, other, "x"), (3, third, "x"), (1, third, "q")]
    rows += [(5, mine, "copy")] * 6 + [(None, mine, "nameless"), (None, None, "nameless")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string")
    kept = sorted(tuple(r) for r in simhash_golay.keep_first(df).collect() if r.doc_id is not None)
    assert kept == sorted([(1, mine, "x"), (1, other, "y"), (1, third, "q")])
    assert simhash_golay.keep_first(df).filter("doc_id is null").count() == 2


def test_copies_of_a_row_say_their_repeats_once(spark):
    """A third of all rows are one row: its segments are one set, not one a copy."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 300 + [(i, f"own {i} " + " ".join(f"x{i}y{k}" for k in range(40))) for i in range(2, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_debruijn.remove_repeats(df, window=35, carry=("doc_id",))
    counts = found.groupBy("doc_id").agg(F.sum("result.n_removed").alias("n"), F.count("*").alias("rows"))
    got = {r.doc_id: (r.n, r.rows) for r in counts.collect()}
    assert got == {1: (300 * 60, 300), **{i: (0, 1) for i in range(2, 600)}}


def test_forest_sample_is_one_row_a_document(spark, monkeypatch):
    """An id with a third of all rows is one of the rows that the trees are grown on."""
    seen = []
    grown = isolation_rules.Forest.__init__
    monkeypatch.setattr(isolation_rules, "TREES", 3)
    monkeypatch.setattr(isolation_rules, "PER_TREE", 20)
    monkeypatch.setattr(
        isolation_rules.Forest, "__init__", lambda self, rows: seen.append(len(rows)) or grown(self, rows)
    )
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["ab", "cde", "f", "ghij"], k=60)) + f" q{i}") for i in range(40)]
    rows += [(7, rows[7][1])] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stats = isolation_rules.measured(df).withColumn("n_repeat_words", F.lit(0).cast("long"))
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    isolation_rules.fit(stats, labels)
    assert seen == [40]
