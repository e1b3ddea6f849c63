"""Pages whose attributes, copies and hosts are awkward."""

from slicehouse.llm.html_extract import Node, extract_text, main_text


def test_attributes_are_read_by_exact_name():
    for attrs in (' style="overflow:hidden"', ' title="Hidden costs of oil"', ' href="/item?id=comment-5"', ' data-id="share-1"', " data-class='menu'"):
        assert not Node("div", attrs).says_noise(True) and not Node("div", attrs).says_noise(False)
    for attrs in (" hidden", ' ID = "comments"', " class=share", " title='a' aria-hidden=true"):
        assert Node("div", attrs).says_noise(True)


def test_titles_as_ids_stay_in_articles():
    page = '<article><h2 id="related-work">Related</h2><section id="advertising"><h3>Advertising</h3><p>ads</p></section><div id="social-change">c</div>'
    assert main_text(page + '<div class="share">x</div><ul class="related"><li>y</ul></article>') == "Related\nAdvertising\nads\nc"


def test_form_around_the_page():
    assert main_text("<body><form><div><p>all of the text</p></div><input></form></body>") == "all of the text"
    assert main_text("<body><form><nav>menu</nav><article>text</article></form></body>") == "text"
    assert main_text("<body><p>a much longer text</p><form>search</form></body>") == "a much longer text"


def rows_of(spark, pages):
    return spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, (host, page) in enumerate(pages)], "page_id bigint, url string, html string")


def test_copies_do_not_delete_the_text(spark):
    same = "<html><body><div class='x'><p>the article</p></div></body></html>"
    pages = [("twice", same)] * 2 + [("many", same)] * 40 + [("many", f"<html><body><div class='x'><p>own {i}</p></div></body></html>") for i in range(5)]
    texts = [row.text for row in extract_text(rows_of(spark, pages)).collect()]
    assert sorted(texts) == ["own 0", "own 1", "own 2", "own 3", "own 4"] + ["the article"] * 42


def test_what_holds_all_that_is_left_stays():
    page = "<body><div class='a'>menu</div><div class='b'><div class='c'>text</div></div></body>"
    from slicehouse.llm.html_extract import parse, set_paths

    root = parse(page)
    assert main_text(page, frozenset(node.path for node in set_paths(root))) == "text"


def test_rare_branches_of_a_large_host_go(spark):
    pages = [("big", f"<div class='own'><p>text {i}</p></div>" + ("<div class='box'>notice</div>" if i < 3 else "")) for i in range(200)]
    assert sorted(row.text for row in extract_text(rows_of(spark, pages)).collect()) == sorted(f"text {i}" for i in range(200))


def test_wrappers_with_compound_names_are_no_noise():
    for page in (
        '<div class="content-sidebar-wrap"><main><article>text</article></main></div>',
        '<div id="page" class="site has-sidebar no-header"><article>text</article></div>',
        '<div class="post-content share-enabled"><p>text</p></div>',
        '<article><div class="related-work">text</div></article>',
    ):
        expected = "text"
        assert main_text(page) == expected, page


def test_what_an_article_holds_beside_its_text():
    for name in ("ad-slot", "social-links", "article-related", "comment-list", "newsletter-signup", "cookie-banner", "Share_Buttons"):
        assert main_text(f"<article><p>text</p><div class='{name}'>beside</div></article>") == "text", name
    for name in ("social-change", "comment-free", "no-share", "ad-hoc"):
        assert main_text(f"<article><p>text</p><div class='{name}'>more</div></article>") == "text\nmore", name


def test_comments_and_teasers_are_no_articles():
    page = "<article><p>text</p></article><section class='discussion'><article class='comment-body'>first!</article></section>"
    assert main_text(page) == "text"
    assert main_text("<article class='card'>one</article><article>text</article><article class='teaser-small'>two</article>") == "text"
    assert main_text("<article class='card'>one</article><article class='card'>two</article>") == "one\ntwo"


def test_hostile_pages_take_linear_time():
    import time

    for part in ("<a ", "<div>", '<a "', "<a '\"", "<p><table><td><div>", "</x>", "<!--", "<script", "<script>", "<li>", "<a b=\"", "<", "<p>", "<form>", "<!", "<td><div>"):
        for tail in ("", ">"):
            page = part * (1_000_000 // len(part)) + tail
            start = time.perf_counter()
            main_text(page)
            assert time.perf_counter() - start < 15, (part, tail)


def test_tags_of_any_form():
    from slicehouse.llm.html_extract import tokens

    def named(page):
        return [(name, closing, attributes) for _, _, name, closing, attributes in tokens(page) if name]

    assert named("<a title='>' b=\"<i>\">x</A ><br/><p") == [("a", False, " title='>' b=\"<i>\""), ("a", True, " "), ("br", False, "/")]
    assert named('<a title="never closed> <p>text</p>') == [("p", False, ""), ("p", True, "")]
    assert named("<!-- <p> --><!doctype html><?x?></ 3><script>if (a<b) '<p>'</SCRIPT ><i>") == [("i", False, "")]


def boxed(text, box="<div class='box'><h3>Join us</h3><p>Write to our house every week</p></div>", menu=""):
    return f"<body><div>{menu}</div><article><h1>On {text}</h1><p>{text}</p>{box}<p>more of {text}</p></article></body>"


def test_the_tree_cuts_within_articles(spark):
    """A block that no list names goes from the articles of a host that repeats it, and stays where it does not."""
    pages = [("site", boxed(f"text {i}")) for i in range(6)] + [("few", boxed(f"text {i}")) for i in range(2)]
    texts = {(row.url.split("/")[2], row.text) for row in extract_text(rows_of(spark, pages)).collect()}
    kept = "\nJoin us\nWrite to our house every week\n"
    assert texts == {("site", f"On text {i}\ntext {i}\nmore of text {i}") for i in range(6)} | {("few", f"On text {i}\ntext {i}{kept}more of text {i}") for i in range(2)}


def test_copies_of_an_article_are_no_boilerplate(spark):
    """Pages that hold one article under other menus, adverts and comments count once within it; headings of articles stay."""
    same = [("copies", boxed("one thing", f"<div class='ad'>ad {i}</div>", f"menu {i}")) for i in range(9)]
    headed = [("heads", f"<article><h2>Summary</h2><p>text {i}</p><ul><li>Salt</li><li>own {i}</li></ul></article>") for i in range(5)]
    texts = sorted(row.text for row in extract_text(rows_of(spark, same + headed)).collect())
    assert texts == ["On one thing\none thing\nmore of one thing"] * 9 + [f"Summary\ntext {i}\nSalt\nown {i}" for i in range(5)]


def test_what_a_cut_block_parts_stays_apart():
    from slicehouse.llm.html_extract import parse, set_paths

    page = "<article>before<div class='x'>box</div>behind<hr>end</article>"
    low = frozenset(node.path for node in set_paths(parse(page)) if node.tag in ("div", "hr"))
    assert main_text(page, low) == "before\nbehind\nend"
