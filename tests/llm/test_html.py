"""Marginals against enumeration, held-out pages in other manners, the given pages against their own marks, odd markup."""

import itertools
import math
import random
import re
import time
from html import unescape

from plotloom.llm import html as H
from plotloom.llm.common import read

SCHEMA = "page_id long, url string, html string, text string, n_chars int"
A, B, C = ("A lighthouse keeper wrote this down in the winter of that year, and it was kept.", "The lamp was lit at dusk, and the log was signed every hour until the morning.",
           "Ships passed far out, and the keeper counted them by their lights.")


def text(page):
    return H.main_text(page, *H.trained())


def test_marginals_equal_enumeration():
    rng = random.Random(6)
    for _ in range(20):
        parent = [-1] + [rng.randrange(i) for i in range(1, 8)]
        odds, kinds = [rng.uniform(-2, 2) for _ in parent], [rng.randrange(2) for _ in parent]
        pairs = [[[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)] for _ in range(2)]
        total, on, both = 0.0, [0.0] * 8, [[0.0] * 4 for _ in parent]
        for y in itertools.product((0, 1), repeat=8):
            w = math.exp(sum(o * v for o, v in zip(odds, y)) + sum(pairs[kinds[i]][y[parent[i]]][y[i]] for i in range(1, 8)))
            total += w
            for i in range(8):
                on[i] += w * y[i]
                if i:
                    both[i][2 * y[parent[i]] + y[i]] += w
        got, pair = H.marginals(parent, odds, kinds, pairs)
        assert all(math.isclose(a, b / total, rel_tol=1e-9) for a, b in zip(got, on))
        assert all(math.isclose(pair[i][k], both[i][k] / total, rel_tol=1e-9) for i in range(1, 8) for k in range(4))


def test_pages_in_other_manners():
    want = "\n\n".join(["Head", A, B, C])
    body = f"<h1>Head</h1><p>{A}</p><p>{B}</p><p>{C}</p>"
    links = "".join(f'<li><a href="#{i}">Go {i}</a></li>' for i in range(5))
    frames = [
        f"<html><body><header><a href='/'>Home</a></header><article>{body}</article><footer>{C}</footer></body></html>",
        f"<body><ul class='navbar'>{links}</ul><main>{body}</main><section id='comments'><div class='comment'><p>{C} {A}</p></div></section></body>",
        f"<body><div class='cookie-banner'>{A}</div><div class='post-content'>{body}</div><aside><h2>Other</h2><ul>{links}</ul></aside></body>",
        f"<body><nav>{links}</nav><article>{body}<div class='ad'>{B}</div><form><label>Name</label><input name=x><textarea>t</textarea></form></article></body>",
        f"<body><div id='sidebar'><p>{A}</p></div><div id='main'>{body}<div class='comments'><p>{B}</p><p>{A}</p></div></div><div id='footer'>{B}</div></body>",
        f"<body><div class='newsletter'><p>{A}</p></div><section class='story'>{body}</section><div class='related'><ul>{links}</ul></div></body>",
    ]
    assert [text(f) for f in frames] == [want] * len(frames)


def test_given_pages_by_their_marks(spark):
    rows = read(spark, "/root/testdata/sf0.01", "pages")
    for r in H.extracted(rows).join(rows.select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub("</?b>", "", inside.replace("<br>", " ")))
        assert r.text == "\n\n".join(" ".join(unescape(p).split()) for p in parts if p.strip()) and r.n_chars == len(r.text)


def test_odd_markup():
    art = lambda x: f"<body><nav><ul><li><a href='/'>a</a></li></ul></nav><article>{x}</article></body>"
    assert text(art(f"<p>{A}<p>{B} &lt;b&gt; &#233;&amp")) == f"{A}\n\n{B} <b> é&"
    assert text(art(f"<p title='a > b'>{A}</p><script>if (a<b) '</p>'</script><style>p{{}}</style><!-- <p>no</p> --><p>{B}</p>")) == f"{A}\n\n{B}"
    assert text(art(f"<P>{A} <B>bold</B>\n\t&nbsp;x<br/>y</P><ul><li>{B}<li>{C}</ul>")) == f"{A} bold x y\n\n{B}\n\n{C}"
    assert text(art(f"<p>{A}</p></div></span><p>{B}</p><p>1 < 2</p><p cla")).startswith(f"{A}\n\n{B}\n\n1 < 2")
    assert text(art("<div>" * 3000 + f"<p>{A}</p>")) in (A, "")
    assert len(text(art(f"<p>{A} {B}</p>" * 5000)).split("\n\n")) == 5000


def test_missing_end_tags_leave_the_text():
    body = f"<article><h1>Head</h1><p>{A}</p><p>{B}</p></article>"
    want = f"Head\n\n{A}\n\n{B}"
    for head in ("<head><title>t</title><meta charset=x>", "<html><head><script>x</script><link rel=y><body>", "<head><title>t</title></head><body>",
                 "<head><noscript><style>p{}</style></noscript><title>t</title>"):
        assert text(head + body) == want
    art = lambda x: f"<body><article><p>{A}</p>{x}<p>{B}</p></article><footer><button>More</button><object>o</object></footer></body>"
    for x in ("<svg/>", "<svg viewBox='0 0 1 1' />", "<math/>", "<button>Share", "<object data=x>", "<select><option>one", "<video src=v>", "<canvas id=c>",
              "<button>Share</button>", "<svg><g><path d='M0'/><text>no</text></g></svg>", "<object><p>no</p></object>", "<video><p>no</p></video>",
              "<svg><svg>no</svg>no</svg>", "<select><option>one<option>two</select>", "<iframe src=x></iframe>", "<template><div><p>no</p></div></template>"):
        assert text(art(x)) == f"{A}\n\n{B}", x
    assert text(art(f"<p>{C} <svg><path/></svg>and <button>x</button>on</p>")) == f"{A}\n\n{C} and on\n\n{B}"


def test_rows(spark):
    data = [(1, "u", None, "t", 1), (2, None, "", "t", 1), (3, "u", "just words " * 20, "t", 1), (None, "u", f"<article><p>{A}</p></article>", "t", 1)] + [(5, "u", f"<article><p>{B}</p></article>", "t", 1)] * 2
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in H.extracted(spark.createDataFrame(data, SCHEMA)).collect())
    assert ("1", "", 0) in got and ("2", "", 0) in got and ("None", A, len(A)) in got and got.count(("5", B, len(B))) == 2 and len(got) == 6
    assert H.extracted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages_that_name_no_content_keep_their_paragraphs():
    w, p = H.trained()
    text = lambda h: H.main_text(h, w, p)
    assert text("<body><p>One two three.</p><p>Four five.</p></body>") == "One two three.\n\nFour five."
    assert text("just text") == "just text" and text("<div>plain words here</div>") == "plain words here"
    assert text("<body><nav><a href=x>Home</a></nav><p>Hi there.</p><footer>Foot</footer></body>") == "Hi there."
    assert text("<body>" + "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000) == "deep"
    assert text("<body><nav><a>x</a></nav><footer>c</footer></body>") == ""


def test_stray_and_missing_end_tags_take_linear_time():
    w, p = H.trained()
    begun = time.time()
    for page in ("<body><p>x</p>" + "</p>" * 250_000, "<body>" + "<div>" * 20_000 + "</p>" * 20_000, "<body>" + "<b>" * 8000 + "<p>x" * 20_000):
        H.main_text(page, w, p)
    assert time.time() - begun < 20
