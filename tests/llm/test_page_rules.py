"""Pages without an article element, names of furniture, open and crossed elements, and time."""

import time

import pytest

from kinetra.llm.html import main_text

STOPS = "the of and to in is that for on with as was by this are from it be not have " * 20


def prose(n):
    return STOPS[:n].strip()


@pytest.mark.parametrize("n", [50, 76, 100, 152, 200, 250])
def test_articles_in_plain_containers(n):
    body = "".join(f"<p>{prose(n)}</p>" for _ in range(6))
    want = "\n".join([prose(n)] * 6)
    head, foot = "<div class='header'><a href=/>Home</a> my site</div>", "<div class='footer'>about us and terms of the use of this site for you</div>"
    for page in (
        f"<body>{head}<div id=content>{body}</div>{foot}</body>", f"<body>{body}</body>", f"<body><header><p>{prose(90)}</p></header>{body}<footer><p>{prose(90)}</p></footer>",
        f"<body><nav><a href=/>Home</a><div role=main>{body}</div><footer>x</footer></body>", f"<body><nav><ul><li><a href=/>Home</a></ul><article>{body}</article>{foot}</body>",
        f"<body><div class=sidebar><p>{prose(150)}</p></div><div role='main' class=x>{body}</div></body>",
    ):
        assert main_text(page) == want, page[:120]


NAMES = "cookie-law-info gdpr-consent-dialog cc-window ad_300x250 google-ads-top subscription-box site-footer-v2 related-posts-grid print-only-ad outbrain cookieNotice ad-slot-sticky newsletter-signup share-buttons-kit".split()


@pytest.mark.parametrize("name", NAMES)
def test_composite_names_of_furniture(name):
    body = "".join(f"<p>{prose(220)}</p>" for _ in range(4))
    furniture = f"<div class='{name}'><p>LEAK {prose(230)}</p></div>"
    for page, times in ((f"{furniture}<article>{body}</article>", 4), (f"<article>{body}{furniture}{body}</article>", 8), (f"<div>{body}</div>{furniture}", 4)):
        assert main_text(f"<body>{page}</body>") == "\n".join([prose(220)] * times)


def test_what_stays_of_an_article():
    body = "".join(f"<p>{prose(220)}</p>" for _ in range(3))
    for mark in ("<section id=related-work>", "<section id=cookie-recipe>", "<div class=menu-planning-for-two>", "<section id=share-prices>"):
        assert "KEEP" in main_text(f"<article>{body}{mark}<p>KEEP {prose(230)}</p></article>")
    assert "LEAK" not in main_text(f"<article>{body}</article><article class='teaser box'><p>LEAK {prose(230)}</p></article>")
    assert "LEAK" not in main_text(f"<aside><article><p>LEAK {prose(230)}</p></article></aside><article>{body}</article>")
    text = prose(100)
    assert main_text(f"<article><p>{text}<button>x</button> tail <select><option>a<option>b</select>end <script>if(a<b){{}}</script>done</p></article>") == f"{text} tail end done"
    assert main_text(f"<article><p>{text} <button>open</p><p>{text}</p></article>").endswith(text)


@pytest.mark.parametrize("part", ["</b></x></section>", "<p><button>", "<b><svg><button>x", "<div></p>", "<li><p></ul>", "<script>", "<a href=x>y</a> "])
def test_time_grows_with_length(part):
    page = "<article>" + "<div>" * 3000 + part * (500_000 // len(part))
    began = time.time()
    main_text(page)
    assert time.time() - began < 4
