"""Main text of pages: the text is shuffled once at most, and a large host is dealt by shard."""

from tileplan.llm import pages

SAME = "one two three four five six seven eight nine ten"


def made(spark, n, host="h"):
    rows = [(i, f"https://{host}/{i}", f"<body><p>{SAME}</p><p>w{i}a w{i}b w{i}c</p></body>") for i in range(n)]
    return spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")


def test_text_is_not_shuffled_for_the_result(spark, capsys):
    given = made(spark, 40).unionByName(made(spark, 5, "small"))
    found = pages.main_text(given)
    found.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
    texts = {(r.url, r.text) for r in found.collect()}
    own = lambda i: f"w{i}a w{i}b w{i}c"
    assert texts == {(f"https://h/{i}", own(i)) for i in range(40)} | {(f"https://small/{i}", f"{SAME}\n{own(i)}") for i in range(5)}


def test_a_host_is_dealt_by_shard(spark, monkeypatch):
    seen = []
    frame = type(made(spark, 1))
    first = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, *by: seen.append(by) or first(self, *by))
    monkeypatch.setattr(pages, "SHARD_PAGES", 16)
    assert pages.main_text(made(spark, 100)).where(f"text LIKE '%{SAME}%'").count() == 0
    assert ("host", "shard") in seen
