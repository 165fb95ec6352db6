"""Labelled pages from which the content model is trained: data-y marks where content (1) or the rest (0) begins, for a whole subtree.

Small pages in the manners of many sites; the words are plain filler, since only structure, names and amounts of text are learned.
"""

_S = ("The river had risen overnight, and by morning the lower fields were under water. ",
      "Nobody in the village could remember a spring like it, although the older people tried. ",
      "Two surveyors walked the bank with a chain and a notebook, counting posts as they went. ",
      "They found that the old boundary stones had moved, or that the maps had never been right. ")


def _p(n: int = 1, size: int = 3, attrs: str = "") -> str:
    return "".join(f"<p{attrs}>{''.join(_S[(i + j) % 4] for j in range(size))}</p>" for i in range(n))


def _links(n: int, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/{i}">Link {i}</a></{tag}>' for i in range(n))


_NAV = f"<nav><ul>{_links(6)}</ul></nav>"
_FOOT = '<footer>&copy; site &middot; all of it.</footer>'

LABELLED = [
    f'<body>{_NAV}<div class="ad">{_S[0]}</div><article data-y="1"><h1>Title of it</h1>{_p(6)}</article>{_FOOT}</body>',
    f'<body>{_NAV}<div class="ad">Short words.</div><article data-y="1"><h1>One</h1><p>Word.</p></article><footer>{_S[1]}{_S[0]}</footer></body>',
    f'<body><header><a href="/">Site</a><p>A slogan of the site</p>{_NAV}</header><main data-y="1"><h1>Title</h1>{_p(4)}<ul><li>{_S[0]}</li><li>{_S[1]}</li></ul>{_p(2)}</main>'
    f'<aside class="sidebar"><h3>Related</h3><ul>{_links(8)}</ul>{_p(1, 1)}</aside>{_FOOT}</body>',
    f'<body><div id="header"><h1><a href="/">Site name</a></h1></div><div id="menu">{_links(7, "span")}</div><div id="content" data-y="1"><h2>Title</h2>{_p(5)}'
    f'<div class="advert" data-y="0"><p>{_S[3]}{_S[1]}</p></div>{_p(3)}</div><div id="footer"><p>{_S[2]}</p></div></body>',
    f'<body><div class="cookie-notice"><p>{_S[0]}{_S[1]}</p><button>Accept</button></div><div class="wrapper"><div class="post-content" data-y="1"><h1>Title</h1>{_p(7)}'
    f'<blockquote>{_S[2]}</blockquote></div><section class="comments"><h3>Comments</h3><div class="comment"><p>{_S[0]}{_S[3]}</p></div><div class="comment"><p>{_S[1]}</p></div>'
    f'<form><label>Your name</label><textarea></textarea></form></section></div><div class="site-footer">{_links(4, "span")}</div></body>',
    f'<body>{_NAV}<article data-y="1"><header><h1>Title</h1></header>{_p(4)}<aside data-y="0" class="promo"><p>{_S[1]}{_S[2]}</p></aside>{_p(2)}'
    f'<div id="comments" data-y="0"><ol><li><p>{_S[0]}{_S[1]}{_S[2]}</p></li><li><p>{_S[3]}</p></li></ol></div></article>{_FOOT}</body>',
    f'<body><div class="banner notice"><p>{_S[3]}{_S[0]}{_S[1]}</p></div><div class="nav breadcrumb">{_links(3, "span")}</div><div class="entry" data-y="1">{_p(3)}<pre>x = 1</pre><table>'
    f'<tr><td>{_S[0]}</td><td>12</td></tr></table>{_p(1)}</div><form class="newsletter"><p>{_S[2]}{_S[1]}</p><label>Mail</label></form><div class="share">{_links(4, "span")}</div></body>',
    f'<body data-y="1"><h1>Bare page</h1>{_p(3)}</body>',
    f'<body><p data-y="1">{_S[0]}{_S[1]}</p><p data-y="1">{_S[2]}</p><div class="footer">{_S[3]}</div></body>',
    f'<body><div><div><ul class="menu">{_links(9)}</ul></div><div data-y="1"><h1>Title</h1>{_p(5)}<h2>Part</h2>{_p(4)}</div><div class="widget"><h4>Popular</h4><ul>{_links(5)}</ul></div></div></body>',
    f'<body><section class="story" data-y="1"><h1>Title</h1>{_p(4)}<figure><figcaption>{_S[1]}</figcaption></figure><div class="sponsored" data-y="0">{_S[0]}{_S[2]}</div>{_p(3)}'
    f'<form data-y="0"><p>{_S[1]}</p></form></section><section class="related"><h3>More</h3>{_p(2, 1)}</section><div role="contentinfo">{_S[0]}</div></body>',
    f'<body><div role="navigation">{_links(6, "span")}</div><div role="main" data-y="1">{_p(2)}<div>{_S[0]}{_S[1]}</div><div>{_S[2]}</div></div><div role="complementary">{_p(2)}</div>'
    f'<div class="reader-comments"><article class="comment"><p>{_S[3]}{_S[2]}</p></article><article class="comment">{_p(1)}</article></div></body>',
    f'<body><div class="popup modal"><p>{_S[2]}{_S[0]}</p></div><div class="subscribe">{_S[1]}</div><article data-y="1"><h1>T</h1>{_p(9, 4)}<p>End.</p></article><div class="ads">{_p(2)}</div>{_FOOT}</body>',
    f'<body>{_NAV}<aside>{_p(3)}</aside><article data-y="1"><h1>Much of it</h1>{_p(3, 1)}<div class="ad" data-y="0">{_p(1)}</div><nav data-y="0"><ol>{_links(4)}</ol></nav>{_p(2, 1)}</article>'
    f'<div class="cookies">{_S[0]}</div><div class="disclaimer alert">{_p(1)}</div>{_FOOT}</body>',
    f'<body>{_NAV}<section data-y="1"><h1>Title</h1><section><h3>Part</h3>{_p(3)}<ol><li>{_S[0]}</li><li>{_S[2]}</li></ol></section><section><h3>Part</h3>{_p(2)}</section></section>{_FOOT}</body>',
    f'<body><div class="top"><ul>{_links(5)}</ul></div><div data-y="1"><div><h1>Title</h1><div>{_p(3)}</div><div>{_p(2)}</div></div></div><div class="bottom"><h3>See too</h3><ol>{_links(4)}</ol></div></body>',
    f'<body><article data-y="1"><h1>T</h1>{_p(2)}<ul><li>One thing</li><li>Another</li></ul><h3>Sub</h3>{_p(1)}<dl><dt>Term</dt><dd>{_S[0]}</dd></dl></article><div class="side">{_p(1)}</div></body>',
]

#: Names of boxes that are not content, and of boxes that are; each stands in a page of its own.
OFF = ("ad ads advert advertisement banner sponsor promo menu nav navbar navigation breadcrumb header masthead footer sidebar widget cookie consent notice gdpr alert popup "
        "modal newsletter subscribe signup login share social related recommended comment reply discussion respond disqus").split()
ON = "content article post entry story main body text page column".split()

for _k, _name in enumerate(OFF):
    _box = f'<{("div", "section", "aside")[_k % 3]} {("class", "id")[_k % 2]}="{_name}" data-y="0">{(_p(1), _p(4), _S[_k % 4], _p(8, 1))[_k % 4]}</{("div", "section", "aside")[_k % 3]}>'
    _inside = (_k // 2 + _k // 16) % 2
    LABELLED.append(f'<body>{_NAV if _k % 3 else ""}<{("article", "div")[_k % 2]} data-y="1"><h1>Title</h1>{_p(2 + _k % 3)}{_box * _inside}{_p(1)}</{("article", "div")[_k % 2]}>'
                    f'{_box * (1 - _inside)}{_FOOT if _k % 2 else ""}</body>')
for _k, _name in enumerate(ON):
    LABELLED.append(f'<body>{_NAV}<div class="{_name}" data-y="1"><h2>Title</h2>{_p(1 + _k % 4)}</div><div class="box">{_links(3, "span")}</div>{_FOOT}</body>')
