"""Labelled example pages from which the extraction model learns.

Elements with the attribute ``data-main`` are main text with everything inside, elements with
``data-rest`` are not; an element without either is labelled as the one around it. Pages are
put together from common page parts by a seeded generator, so that every part occurs in many
surroundings.
"""

from __future__ import annotations

import random

WORDS = (
    "time year people way day man thing woman life child world school state family student group country problem hand "
    "part place case week company system program question work government number night point home water room mother "
    "area money story fact month lot right study book eye job word business issue side kind head house service friend"
).split()

#: Markup of parts around the main text; # is replaced by words, @ by one word.
REST = (
    "<nav><ul>{links}</ul></nav>",
    '<ul class="menu">{links}</ul>',
    '<div id="navigation"><a href="/@">@</a> | <a href="/@">@</a> | <a href="/@">@</a></div>',
    '<div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/@">@</a></div>',
    '<header><a href="/">#</a><h1>#</h1></header>',
    '<div class="header banner"><img src="@.png"><span>#</span></div>',
    "<header><p>#</p><nav>{links}</nav></header>",
    "<footer>&copy; @ #.</footer>",
    '<footer><p>#</p><a href="/@">@</a><a href="/@">@</a></footer>',
    '<div id="footer" class="site-footer"><p>Copyright #. #</p></div>',
    "<aside><h3>#</h3><p>#. #.</p></aside>",
    '<aside class="sidebar"><ul>{links}</ul><p>#</p></aside>',
    '<div class="sidebar"><h4>#</h4><p>#. #. #.</p></div>',
    '<div class="related"><h3>Related</h3><ul>{links}</ul></div>',
    '<div class="ad">#.</div>',
    '<div class="ads advert sponsored"><p>#. #</p></div>',
    '<section class="promo"><h2>#</h2><p>#. #.</p><a href="/@">@</a></section>',
    '<div class="cookie notice">#. <button>@</button></div>',
    '<div id="consent" role="dialog"><p>#. #.</p><button>@</button><button>@</button></div>',
    '<p class="notice">#. #</p>',
    '<form action="/@"><label>@</label><input name="@"><select><option>@</option><option>@</option></select><button>@</button></form>',
    '<div class="newsletter"><p>#</p><form><input><button>@</button></form></div>',
    '<section id="comments" class="comments"><h3>@</h3><div class="comment"><b>@</b><p>#. #.</p></div><div class="comment"><p>#</p></div></section>',
    '<ol class="comment-list"><li><p>#. #. #.</p></li><li><p>#.</p></li></ol>',
    '<div class="share social"><a href="/@">@</a><a href="/@">@</a></div>',
    '<div class="popup modal"><p>#</p></div>',
    '<noscript><p>#</p></noscript>',
)
#: Parts of the main text.
MAIN = (
    "<p>#. #. #.</p>",
    "<p>#. #. #. #. #. #. #.</p>",
    "<p>#.</p>",
    "<p>@.</p>",
    "<p>#. <b>#</b> #. <i>@</i> #.</p>",
    '<p>#. <a href="/@">@ @</a> #. #.</p>',
    "<p><b>#. #.</b><br>#. #.</p>",
    "<h1>#</h1>",
    "<h2>#</h2>",
    "<h3>@</h3>",
    "<ul><li>#</li><li>#. #.</li><li>@</li></ul>",
    "<ol><li><p>#. #.</p></li><li>#</li></ol>",
    "<blockquote><p>#. #.</p></blockquote>",
    "<pre>#</pre>",
    "<table><tr><th>@</th><td>#</td></tr><tr><th>@</th><td>@</td></tr></table>",
    "<figure><img src='@.png'><figcaption>#</figcaption></figure>",
    "<div>#. #. #.</div>",
    "<section><h2>#</h2><p>#. #.</p></section>",
    "<dl><dt>@</dt><dd>#. #.</dd></dl>",
    "<p><span>#. #.</span> <em>@</em> <code>@</code></p>",
)
WRAPPERS = (
    "<article data-main>{}</article>",
    "<article data-main>{}</article>",
    "<article class='post entry' data-main>{}</article>",
    "<main><article data-main>{}</article></main>",
    "<main data-main>{}</main>",
    '<main id="content" data-main>{}</main>',
    '<div class="content" data-main>{}</div>',
    '<div id="main"><div class="article-body post text" data-main>{}</div></div>',
    '<div class="container"><div class="entry-content" data-main>{}</div></div>',
    "<div data-main>{}</div>",
    "<section data-main>{}</section>",
    "<div role='main' data-main>{}</div>",
)


def _fill(markup: str, rng: random.Random) -> str:
    links = "".join("<li><a href='/@'>@</a></li>" for _ in range(rng.randint(2, 7)))
    out = []
    for letter in markup.replace("{links}", links):
        if letter == "#":
            out.append(" ".join(rng.choices(WORDS, k=rng.randint(3, 16))).capitalize())
        else:
            out.append(rng.choice(WORDS).capitalize() if letter == "@" else letter)
    return "".join(out)


def _rest(markup: str) -> str:
    end = min(k for k in (markup.find(" "), markup.find(">")) if k > 0)
    return f"{markup[:end]} data-rest{markup[end:]}"


def example_pages(n: int = 600, seed: int = 11) -> list[str]:
    rng, pages = random.Random(seed), []
    for _ in range(n):
        rest = [_rest(m) for m in rng.choices(REST, k=rng.randint(2, 8))]
        cut = rng.randint(1, len(rest))
        main = list(rng.choices(MAIN, k=rng.randint(2, 12)))
        if rng.random() < 0.35:
            main.insert(rng.randint(0, len(main)), rest.pop())
        body = WRAPPERS[rng.randrange(len(WRAPPERS))].format("".join(main))
        if rng.random() < 0.2:
            body = f"<div class='page wrapper'>{body}</div>"
        head = "<head data-rest><title>#</title><style>p{margin:0}</style><script>var a='#';</script></head>"
        pages.append(_fill(f"<html data-rest>{head}<body data-rest>{''.join(rest[:cut])}{body}{''.join(rest[cut:])}</body></html>", rng))
    return pages
