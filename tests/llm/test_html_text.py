import pytest

from pulsemill.llm.html_text import UNDECIDED, extract_text, main_text, second_pass

LONG = "The river ran past the mill and the old road that led to the town, and in the spring it was high with snow from the hills."


def test_article_without_its_surroundings():
    page = (
        "<html><head><title>t</title><style>p{}</style><script>var a = '<p>no</p>';</script></head><body>"
        "<nav><a href='/'>Home</a> <a href='/a'>About</a></nav><div class='cookie-notice'>We use cookies on the site of ours.</div>"
        f"<article><h1>Mills &amp; rivers</h1><p>{LONG}</p><p>  A&nbsp;short\n one. </p><p>{LONG}</p></article>"
        "<aside>Read more</aside><div id='comments'><p>" + LONG + "</p></div><form><input value='x'>Name</form><footer>Imprint</footer></body></html>"
    )
    assert main_text(page) == f"Mills & rivers {LONG} A short one. {LONG}"


def test_links_and_short_blocks_without_an_article():
    page = f"<body><div><a href='a'>one two three</a></div><p>{LONG}</p><p>Short.</p><p>{LONG}</p><ul><li><a href='x'>Link</a></li></ul></body>"
    assert main_text(page) == f"{LONG} Short. {LONG}"


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<!-- open", "<script>open", "&#", "<p>&amp", "</p></p>", "<a href='x>", "\x00"])
def test_broken_pages_end_without_an_error(page):
    assert isinstance(main_text(page), str)


def test_second_pass_takes_the_nearest_decided_neighbour():
    assert second_pass([1, UNDECIDED, UNDECIDED, UNDECIDED, -1], False) == [True, True, False, False, False]
    assert second_pass([1, UNDECIDED, -1], True) == [True, True, False]
    assert second_pass([UNDECIDED], True) == [True] and second_pass([UNDECIDED], False) == [False]


def test_rows(spark):
    rows = [(1, "u", None, "a"), (2, None, "", "b"), (3, "u", f"<p>{LONG}</p>", None), (3, "u", f"<p>{LONG}</p>", None), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted(extract_text(pages).collect(), key=str)
    assert len(got) == 5 and {r["n_chars"] for r in got} == {0, len(LONG)}
    assert extract_text(pages.limit(0)).collect() == []


PROSE = "It was the first of the days on which the people of the town could see that the river had come up over the road to the mill. "


def test_raw_tags_without_their_end_tag():
    want = (PROSE * 3).strip()
    for page in (
        f"<html><head><title>x</title><body><p>{PROSE * 3}</p></body></html>",
        f"<head><meta charset=utf-8><script>a('<p>')</script><title>x</title><p>{PROSE * 3}",
        f"<body><article><div><button>Menu</div><p>{PROSE * 3}</p><button>Send</button></article></body>",
        *(f"<body><{tag}>Menu<p>{PROSE * 3}</p></body>" for tag in ("button", "select", "svg", "object")),
        *(f"<body><article><div><{tag}>Menu</div><p>{PROSE * 3}</p></article></body>" for tag in ("button", "select", "svg", "object")),
        f"<body><p>{PROSE}<select><option>one<option>two</select>{PROSE * 2}</p></body>",
    ):
        assert " ".join(main_text(page).split()) == want, page


def test_a_teaser_is_not_the_main_part():
    teaser = "<article><h3>Related</h3><p>The mill and the people who ran it in the years before the war, and after.</p></article>"
    for a, z in (("<main>", "</main>"), ('<div class="content">', "</div>")):
        assert PROSE.strip() in main_text(f"<body>{a}{f'<p>{PROSE}</p>' * 5}{z}{teaser}</body>")
        assert main_text(f"<body>{a}{f'<p>{PROSE}</p>' * 5}{teaser}{z}</body>").count(PROSE.strip()) == 5


PROSE = "the cat sat on the mat and looked at the long road that led away from the old house by the sea, and it was good to be there. "


def test_prose_around_the_surest_part_stays():
    page = f"<main><p>{PROSE} lead</p><article><p>{PROSE * 3}</p></article><p>{PROSE} tail</p><p>short</p></main><p>{PROSE} outside</p>"
    got = main_text(page)
    assert "lead" in got and "tail" in got and "outside" not in got


def test_end_tags_without_a_start_take_linear_time():
    import time

    began = time.thread_time()
    main_text("<div><span>" * 50_000 + "</p>" * 50_000 + "</section></div>" * 20_000)
    assert time.thread_time() - began < 10
