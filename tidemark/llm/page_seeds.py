"""Hand-labelled page layouts that page extraction learns from.

``data-main`` marks the element that holds the main text, ``data-apart`` elements inside it that don't belong. The marks
are labels only; features never see them. The layouts are made up for this purpose.
"""

_LONG = "It was the third morning of the fair, and the square had filled long before the bells; nobody, least of all the mayor, had expected such a crowd. "
_P = f"<p>{_LONG}{_LONG}</p><p>{_LONG}</p><p>A short one, too.</p>"
_LIST = "<ul><li>First, measure the flour.</li><li>Then add the water slowly, and stir until it is smooth.</li></ul>"
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
_FORM = '<form action="/s"><label>Your address</label><input name="q"><button>Subscribe now</button><p>We never share it.</p></form>'
_REMARKS = "<h3>Comments</h3><ul><li><p>I don't agree with this at all, it rained.</p></li><li><p>Nice read, thank you!</p></li></ul>"

SEEDS = [
    f'<html><body><div class="header"><h1>Daily Paper</h1></div><div class="nav">{_MENU}</div><div class="content" data-main><h1>A fair</h1>{_P}</div><div class="sidebar"><h3>Most read</h3>{_MENU}</div><div class="footer"><p>All rights reserved.</p></div></body></html>',
    f'<html><body><header><div class="logo">Paper</div><nav>{_MENU}</nav></header><main><div class="post" data-main><h2>The fair</h2>{_P}{_LIST}</div><div class="comments">{_REMARKS}</div></main><footer><p>Imprint</p></footer></body></html>',
    f'<html><body><div id="cookie-banner" class="notice"><p>This site uses cookies. By going on you accept them.</p><button>Accept</button></div><div id="menu">{_MENU}</div><div id="main" data-main><h1>Bread</h1>{_P}<blockquote><p>{_LONG}</p></blockquote></div><div id="related"><h3>Related</h3>{_MENU}</div></body></html>',
    f'<html><body><nav>{_MENU}</nav><article data-main><h1>Fair</h1>{_P}<aside data-apart><h3>See also</h3>{_MENU}</aside>{_P}<div class="share social" data-apart><p>Share this</p></div><section class="comments" data-apart>{_REMARKS}</section></article><aside><p>Weather: mild.</p></aside><footer><p>About</p></footer></body></html>',
    f'<html><body><div class="wrapper"><div class="topbar"><p>Call us now</p></div><div class="article-body" data-main>{_P}<h2>Then</h2>{_P}<div class="ad advert" data-apart><p>Buy two, pay for one! This week only.</p></div>{_P}</div><div class="newsletter">{_FORM}</div></div></body></html>',
    f'<html><body><table><tr><td class="left">{_MENU}</td><td class="text" data-main>{_P}</td></tr></table><div class="copyright">Copyright the owners</div></body></html>',
    f'<html><body><header><h1>Shop</h1></header><div role="main"><div class="breadcrumb">{_MENU}</div><div class="entry" data-main><h1>Notes</h1>{_P}<table><tr><th>Year</th><td>1901</td></tr><tr><th>Price</th><td>Two crowns a piece</td></tr></table></div>{_FORM}</div><footer>{_MENU}</footer></body></html>',
    f'<html><body><main data-main><h1>Why it rained</h1>{_P}<pre>print(1)</pre>{_LIST}<form data-apart><p>Vote here</p><button>Send</button></form></main><div class="promo banner"><p>Subscribe today and save half of the price of a year.</p></div></body></html>',
    f'<html><body><div class="popup modal"><p>Join our list to get the news every day.</p></div><section class="story" data-main><header><h1>The bridge</h1></header>{_P}<figure><figcaption>The bridge in spring.</figcaption></figure></section><section class="recommended"><h2>More stories</h2>{_MENU}</section></body></html>',
    f'<html><body><div class="sponsored ads"><p>Advertisement: new shoes for everyone, at last.</p></div><article data-main><h1>Sums</h1>{_P}</article><div class="disqus thread" id="comments">{_REMARKS}</div><div class="widget sidebar">{_MENU}<p>Tags and topics</p></div></body></html>',
    f'<html><body><div class="alert notice warning"><p>The office is closed on Monday because of the holiday.</p></div><nav class="navbar">{_MENU}</nav><div class="page"><article data-main><h1>Boats</h1>{_P}</article><aside class="sidebar"><h3>Archive</h3>{_MENU}<p>{_LONG}</p></aside></div><footer class="footer"><p>{_LONG}</p></footer></body></html>',
    f'<html><body><div class="ad">{_LONG}</div><article data-main><h1>A day out</h1>{_P}<section class="comments replies" data-apart><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>Well said.</p></div></section></article><footer>&copy; the site &middot; {_LONG}</footer></body></html>',
    f'<html><body><header class="site-header"><p>The site of the town</p><form class="search"><input><button>Search</button></form></header><div class="content" data-main><p>{_LONG}</p><dl><dt>Bell</dt><dd>{_LONG}</dd></dl></div><div class="login">{_FORM}</div></body></html>',
    f'<html><body data-main><h1>A letter</h1>{_P}{_LIST}</body></html>',
    f'<html><body data-main><h1>Diary</h1>{_P}<div class="nav" data-apart>{_MENU}</div></body></html>',
    f'<html><body><nav>{_MENU}</nav><div class="ad">Buy now</div><article data-main><h1>Yes</h1><p>Yes.</p></article><footer>End of page</footer></body></html>',
    '<article data-main><p>Two words</p><p>One</p></article>',
    '<article data-main><h1>Note</h1><p>cut</p><ul><li>x</li><li>y</li></ul></article><div class="ad">x</div>',
    f'<html><body><div class="menu">{_MENU}</div><main data-main><p>It rained.</p></main><div class="cookie">OK?</div></body></html>',
]
