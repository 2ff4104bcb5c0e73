"""Several templates in one leaf of the line tree, and the SQL on the same texts."""

import random

import duckdb
import pytest

from cardwatch.llm import line_templates
from cardwatch.llm.queries import LINES_SQL
from compare import difference

TOWN = "Read more about the great old town of {} right here"
OFFER = "Read more about our big new weekly offer from {} now"
LATE = "Read more about {} in our weekly printed news of today"
OTHER = "Read more about {0}a {0}b {0}c {0}d {0}e {0}f {0}g {0}h"


def documents(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def agrees(texts, found) -> bool:
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    return difference(con, LINES_SQL, found) is None


@pytest.mark.parametrize("kinds", [[TOWN], [OFFER], [LATE], [TOWN, OFFER], [TOWN, LATE], [TOWN, OFFER, LATE, OTHER]])
def test_the_fate_of_a_line_does_not_depend_on_unlike_lines_of_its_leaf(spark, kinds):
    texts = [kind.format("".join(chr(97 + int(d)) for d in str(i))) for kind in kinds for i in range(10, 18)]
    found = line_templates.drop_recurring(documents(spark, texts))
    dropped = {r.doc_id for r in found.where("n_dropped = 1").collect()}
    expected = {8 * k + i for k, kind in enumerate(kinds) if kind != OTHER for i in range(1, 8)}
    assert dropped == expected
    assert agrees(texts, found)


def test_short_missing_and_repeated_lines_on_all_levels_equal_sql(spark):
    rng = random.Random(7)
    words = ["sun", "sea", "sky", "<*>", "x"]
    lines = [" ".join(rng.choice(words[:2]) if i < 3 else rng.choice(words) for i in range(rng.randrange(0, 9))) for _ in range(400)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12))) for _ in range(120)] + [None, "", "\n\n", " \t ", "sun"]
    texts += [lines[0]] * 6
    found = line_templates.drop_recurring(documents(spark, texts))
    assert found.count() == len(texts)
    assert agrees(texts, found)
