"""Labelled pages that the field of ``html_extract`` is trained on.

Layouts were written and labelled by hand: an element with ``data-main`` is main text, what
stands inside ``{...}`` is filled with words (so many, up to so many). The number of training
pages is ``COPIES`` for each layout, whatever the size of the crawl.
"""

from __future__ import annotations

import random
import re

COPIES = 8
_SYLLABLES = "an ber ko lu mi na or pe ra si to un ve wa éle für són ñi da ge".split()
_PROSE = "<p data-main>{20-90}</p><p data-main>{5-60}</p><p data-main>{12-70}</p>"
_MENU = "<ul><li><a href='/a'>{1}</a></li><li><a href='/b'>{1-2}</a></li><li><a href='/c'>{1-2}</a></li></ul>"
_FOOT = "<footer>&copy; example.org &middot; {4-9}</footer>"

LAYOUTS = [
    f"<body><nav>{_MENU}</nav><div class='ad'>{{4-12}}</div><article><h1 data-main>{{4-9}}</h1>{_PROSE}</article>{_FOOT}</body>",
    f"<body><nav>{_MENU}</nav><article><h1 data-main>{{2-6}}</h1><p data-main><b>{{3-9}}<br><p data-main>{{30-80}}</p><p data-main>{{1-3}}</p></article>{_FOOT}",
    f"<body><header><h1>{{1-3}}</h1><p>{{3-8}}</p>{_MENU}</header><main><article><h1 data-main>{{3-9}}</h1>{_PROSE}<h2 data-main>{{2-5}}</h2>{_PROSE}</article></main>{_FOOT}</body>",
    f"<body><div id='header'><a href='/'>{{1-2}}</a></div><div id='menu'>{_MENU}</div><div id='content'><h1 data-main>{{3-8}}</h1>{_PROSE}<ul data-main><li>{{3-12}}</li><li>{{3-12}}</li></ul>{_PROSE}</div><div id='sidebar'><h3>{{1-3}}</h3>{_MENU}<p>{{8-30}}</p></div><div id='footer'>{{5-14}}</div></body>",
    f"<body><div class='cookie notice'><p>{{10-25}}</p><button>{{1}}</button></div><header class='site'>{_MENU}</header><article class='post'><header data-main><h1>{{4-9}}</h1></header><div class='body' data-main><p>{{30-80}}</p><blockquote><p>{{8-30}}</p></blockquote><p>{{20-60}}</p></div></article><section class='comments' id='comments'><h3>{{1-2}}</h3><div class='comment'><p>{{5-40}}</p></div><div class='comment'><p>{{8-60}}</p></div><form><label>{{1-2}}</label><textarea></textarea><input type='submit'></form></section>{_FOOT}</body>",
    f"<body><nav>{_MENU}</nav><main><h1 data-main>{{3-8}}</h1>{_PROSE}<aside class='related'><h4>{{1-3}}</h4>{_MENU}</aside>{_PROSE}<div class='advert'>{{5-20}}</div>{_PROSE}</main><aside><p>{{15-50}}</p></aside>{_FOOT}</body>",
    f"<body><div class='wrapper'><div class='top banner'>{{4-9}}</div><div class='nav'>{_MENU}</div><div class='entry'>{_PROSE}<pre data-main>{{8-30}}</pre><table data-main><tr><th>{{1-2}}</th><td>{{1-4}}</td></tr><tr><th>{{1-2}}</th><td>{{1-4}}</td></tr></table></div><div class='share social'>{_MENU}</div><div class='newsletter'><form><p>{{8-20}}</p><label>{{1-3}}</label></form></div></div><div class='footer legal'>{{8-20}}</div></body>",
    f"<body><article><aside class='ad sponsored'><p>{{10-40}}</p></aside><h1 data-main>{{3-8}}</h1>{_PROSE}<div class='promo'><p>{{10-30}}</p></div>{_PROSE}<footer><p>{{4-10}}</p></footer><section class='comments'><p>{{10-60}}</p><p>{{10-60}}</p></section></article><footer>{_MENU}<p>{{5-15}}</p></footer></body>",
    f"<body><p>{{1-3}}</p><table><tr><td class='menu'>{_MENU}</td><td class='story'>{_PROSE}{_PROSE}</td></tr></table><p><small>{{4-10}}</small></p></body>",
    f"<body><header>{_MENU}</header><form action='/search'><label>{{1-2}}</label><select><option>{{1}}<option>{{1}}</select><p>{{5-12}}</p></form><section><article><h2 data-main>{{3-7}}</h2>{_PROSE}<figure data-main><figcaption>{{4-14}}</figcaption></figure></article></section><div role='alert' class='alert'>{{6-24}}</div><ol class='breadcrumbs'><li><a href='/'>{{1}}</a></li><li>{{1-3}}</li></ol>{_FOOT}</body>",
    f"<body><nav>{_MENU}</nav><div class='ad'>{{4-12}}</div><article></article>{_FOOT}</body>",
    f"<body>{_PROSE}</body>",
    f"<body><h1 data-main>{{2-8}}</h1>{_PROSE}{_PROSE}</body>",
    f"<body><nav>{_MENU}</nav><article><h1 data-main>{{3-8}}</h1><p data-main>{{1-4}}</p><div data-main>{{10-50}}</div><dl data-main><dt>{{1-3}}</dt><dd>{{5-20}}</dd></dl><p data-main><a href='/x'>{{3-8}}</a></p>{_PROSE}</article><div class='sidebar widget'><p>{{20-60}}</p></div><div class='ads'><p>{{20-60}}</p></div>{_FOOT}</body>",
    f"<body><aside><p>{{30-80}}</p><p>{{30-80}}</p></aside><article>{_PROSE}<p data-main>{{2-5}}</p></article><div id='disqus' class='reader responses comments'><article class='comment'><p>{{20-60}}</p></article><article class='comment'><p>{{20-60}}</p></article></div><div class='notice privacy gdpr'><p>{{20-40}}</p></div>{_FOOT}</body>",
]


def pages() -> list[str]:
    """Every layout ``COPIES`` times with other words; the same in every call."""
    draw = random.Random(7)

    def words(found: re.Match) -> str:
        n = draw.randint(int(found[1]), int(found[2] or found[1]))
        some = ["".join(draw.choices(_SYLLABLES, k=draw.randint(1, 4))) for _ in range(n)]
        return " ".join(some).capitalize() + ("." if n >= 8 or draw.random() < 0.2 else "")

    return [re.sub(r"\{(\d+)(?:-(\d+))?\}", words, layout) for layout in LAYOUTS for _ in range(COPIES)]
