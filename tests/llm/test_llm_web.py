"""Pages, lists of URLs and conversations on hand-made tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from slicehouse.llm.html_extract import extract_text, main_text, node_importance, page_host
from slicehouse.llm.preference import preference_examples
from slicehouse.llm.url_filter import filter_captures

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="ad banner">Buy</div><!-- <p>gone</p> -->
<article><h1>Head &amp; line</h1><p><b>One &lt;two&gt; &#233;<br>three<p>Four   five
six<div class="share">Tweet</div><ul><li>seven<li>eight</ul><table><tr><td>nine<td>ten</table><form><p>Name</p></form>
<section id="comments"><p>First!</p></section><aside>More</aside></article>
<footer>&copy; all</footer></body>"""


def test_article_of_a_page():
    assert main_text(PAGE) == "Head & line\nOne <two> é three\nFour five six\nseven\neight\nnine\nten"


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("plain  text", "plain text"),
        ("<p>open <b>end", "open end"),
        ("<article>", ""),
        ("</div></p><p>a</p>", "a"),
        ("<script>never closed", ""),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<article>a</article><aside><article>teaser</article></aside><article>b</article>", "a\nb"),
        ("a < b <p>c > d", "a < b\nc > d"),
        ("<p title='>'>x</p>", "x"),
        ("<div hidden>h</div><p>x</p>", "x"),
        ("<article><header><h1>t</h1></header><p>x</p><footer>by</footer></article><header>site</header>", "t\nx"),
    ],
)
def test_pages_of_any_form(page, text):
    assert main_text(page) == text


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text("<article><p>" + "word " * 300_000 + "</article>").count("word") == 300_000


PAGES = "page_id bigint, url string, html string, text string, host string"


def pages(spark, rows):
    return spark.createDataFrame([(i, url, html, "t", "h") for i, url, html in rows], PAGES)


def test_branches_that_a_site_repeats_go(spark):
    body = "<div class='x'><p>Same words on every page</p></div><div class='y'><p>{}</p></div>"
    rows = [(i, f"http://A.example/{i}", body.format(f"own text {i}")) for i in range(6)]
    rows += [(10, "http://b.example:80/", body.format("alone")), (11, None, "<p>no host</p>"), (12, "http://b.example/2", None), (0, "http://A.example/0", body.format("own text 0"))]
    got = extract_text(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text"]
    texts = [(row.page_id, row.text) for row in got.collect()]
    assert sorted(texts) == sorted(
        [(i, f"own text {i}") for i in range(6)] + [(0, "own text 0"), (10, "Same words on every page\nalone"), (11, "no host"), (12, "")]
    )
    assert extract_text(pages(spark, [])).count() == 0


def test_importance_is_between_none_and_one(spark):
    rows = [(i, "http://a.example/", f"<div><p>{i % 2}</p></div><nav>n</nav>") for i in range(8)]
    frame = pages(spark, rows).select(page_host(F.col("url")).alias("host"), "html")
    found = [row.importance for row in node_importance(frame).collect()]
    assert all(0 <= one <= 1 for one in found)
    assert any(one == 0 for one in found) and any(abs(one - 1 / 3) < 1e-9 for one in found)


def moment(text):
    return datetime.datetime.fromisoformat(text)


def test_entries_are_judged_at_the_time_of_the_capture(spark):
    entries = spark.createDataFrame(
        [
            ("bad.example", moment("2024-01-10 12:00"), 1, "block"),
            ("bad.example", moment("2024-02-10 12:00"), 2, "remove"),
            ("bad.example", moment("2024-03-10 00:00"), 3, "block"),
            ("www.bad.example", moment("2024-03-20 10:00"), 4, "allow"),
            ("www.bad.example", moment("2024-03-20 10:00"), 5, "block"),
            ("www.bad.example", moment("2024-03-20 11:00"), 6, "allow"),
            (None, moment("2024-01-01 00:00"), 7, "block"),
            ("bad.example", None, 8, "block"),
        ],
        "key string, at timestamp_ntz, entry_id int, action string",
    )
    captures = [
        (1, "http://bad.example/x", "2024-01-10 11:59", None),
        (2, "http://u:p@BAD.example:80/x", "2024-01-10 12:00", 1),
        (3, "https://a.bad.example", "2024-02-10 11:59", 1),
        (4, "http://bad.example/", "2024-02-10 12:00", None),
        (5, "http://bad.example/", "2024-03-10 00:00", 3),
        (6, "http://www.bad.example/", "2024-03-20 09:00", 3),
        (7, "http://www.bad.example/", "2024-03-20 10:30", 5),
        (8, "http://www.bad.example/", "2024-05-01 00:00", 6),
        (9, None, "2024-05-01 00:00", None),
        (10, "no url", "2024-05-01 00:00", None),
        (11, "http://bad.example/", None, None),
        (None, "http://bad.example/", "2024-12-01 00:00", 3),
        (5, "http://bad.example/", "2024-03-10 00:00", 3),
        (12, "http://notbad.example/", "2024-12-01 00:00", None),
    ]
    frame = spark.createDataFrame([(i, url, time and moment(time), "key", 0) for i, url, time, _ in captures], "page_id int, url string, fetched_at timestamp_ntz, key string, row int")
    got = sorted(((row.page_id, row.entry_id, row.blocked) for row in filter_captures(frame, entries).collect()), key=str)
    assert got == sorted(((i, entry, entry in (1, 3, 5)) for i, _, _, entry in captures), key=str)
    assert filter_captures(frame, entries.limit(0)).filter("blocked").count() == 0
    assert filter_captures(frame.limit(0), entries).count() == 0


TURNS = "pair_id bigint, side string, turn bigint, role string, text string, prompt string"


def examples(spark, rows):
    frame = spark.createDataFrame([(*row, "p") for row in rows], TURNS)
    return {row.pair_id: row for row in preference_examples(frame).collect()}


def test_prefix_once_and_masked_completions(spark):
    shared = [(0, "system", "Be kind"), (1, "user", "Hi")]
    rows = [(1, side, *turn) for side in ("chosen", "rejected") for turn in shared]
    rows += [(1, "chosen", 2, "assistant", "Hello"), (1, "chosen", 3, "user", "Bye"), (1, "chosen", 4, "assistant", ""), (1, "rejected", 2, "assistant", "Go")]
    rows += [(2, "chosen", 0, "user", "same"), (2, "rejected", 0, "user", "same")]
    rows += [(3, "chosen", 0, "assistant", None), (3, "rejected", 0, None, None), (4, "chosen", 0, "user", "alone"), (4, "other", 1, "user", "x")]
    rows += [(None, "chosen", 0, "user", "x"), (5, "chosen", None, "user", "x"), (1, "chosen", 1, "user", "Hi")]
    got = examples(spark, rows)
    assert set(got) == {1, 2, 3, 4}
    one = got[1]
    assert (one.prompt_turns, one.prompt) == (2, "<|system|>\nBe kind<|end|>\n<|user|>\nHi<|end|>\n")
    learnt = lambda text, mask: [text[span.start : span.start + span.length] for span in mask]
    assert learnt(one.chosen, one.chosen_mask) == ["Hello<|end|>\n", "<|end|>\n"]
    assert learnt(one.rejected, one.rejected_mask) == ["Go<|end|>\n"]
    assert one.chosen == "<|assistant|>\nHello<|end|>\n<|user|>\nBye<|end|>\n<|assistant|>\n<|end|>\n"
    assert (got[2].prompt_turns, got[2].chosen, got[2].rejected, got[2].chosen_mask) == (1, "", "", [])
    assert (got[3].chosen, got[3].rejected) == ("<|assistant|>\n<|end|>\n", "<||>\n<|end|>\n")
    assert (got[4].prompt, got[4].rejected) == ("", "")
    assert examples(spark, []) == {}


def test_a_very_long_conversation(spark):
    rows = [(1, side, turn, "assistant" if turn % 2 else "user", f"{turn}" if turn < 900 or side == "chosen" else "no") for side in ("chosen", "rejected") for turn in range(1000)]
    got = examples(spark, rows)[1]
    assert got.prompt_turns == 900 and len(got.chosen_mask) == 50


def plain_filter(captures, entries):
    """For each capture: of its host and the domains above it the longest with an active entry."""
    out = []
    for row, url, at in captures:
        host = url.split("/")[2] if url and "://" in url else ""
        labels, found = host.split("."), None
        for depth in range(len(labels) - 1 if at else 0):
            key = ".".join(labels[depth:])
            valid = [(when, number, action) for own, when, number, action in entries if own == key and when and when <= at]
            if valid and max(valid)[2] != "remove":
                found = (key, max(valid)[1], max(valid)[2])
                break
        out.append((row, *(found or (None, None, None))))
    return sorted(out, key=str)


def test_one_host_with_most_captures_and_entries(spark):
    """Rows of a busy key and day are dealt out like any others, and none is paired with all entries."""
    import random

    from slicehouse.llm import url_filter

    rng = random.Random(7)
    start = datetime.datetime(2024, 5, 1)
    hosts = ["busy.example.org"] * 4 + ["a.example.org", "example.org", "b.test", "lonely.net"]
    moment = lambda: start + datetime.timedelta(seconds=rng.randrange(0, 86400, 60))
    captures = [(i, f"http://{rng.choice(hosts)}/{i}", moment()) for i in range(900)] + [(900, None, start), (901, "http://b.test/", None), (902, "nonsense", start)]
    entries = [(rng.choice(hosts), moment(), i, rng.choice(["block", "allow", "remove"])) for i in range(400)] + [(None, start, 400, "block"), ("b.test", None, 401, "block")]
    c = spark.createDataFrame(captures, "page_id bigint, url string, fetched_at timestamp_ntz").repartition(5)
    e = spark.createDataFrame(entries, "key string, at timestamp_ntz, entry_id bigint, action string")
    got = filter_captures(c, e)
    assert sorted(((row.page_id, row.list_key, row.entry_id, row.action) for row in got.collect()), key=str) == plain_filter(captures, entries)
    asked = c.select("url", F.col("fetched_at").alias("at"), F.col("page_id").alias("row"), F.lit(0).alias("depth"), F.lit("busy.example.org").alias("key"))
    found = url_filter.as_of(asked.where("at IS NOT NULL"), e)
    assert found.count() == 902
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "day" not in plan


def test_no_entries_and_no_captures(spark):
    c = spark.createDataFrame([(1, "http://a.b/", datetime.datetime(2024, 1, 1))], "page_id bigint, url string, fetched_at timestamp_ntz")
    e = spark.createDataFrame([], "key string, at timestamp_ntz, entry_id bigint, action string")
    assert [(row.host, row.blocked, row.list_key) for row in filter_captures(c, e).collect()] == [("a.b", False, None)]
    assert filter_captures(c.limit(0), e).count() == 0
