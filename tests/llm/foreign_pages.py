"""Hand-written pages of layouts that the training pages were not made from, each with its main text."""

LOREM = "The river rises in the hills above the town, and it has been dammed twice since the war. Farmers along its banks still grow hops."
MORE = "In spring the water is high enough for barges, which carry gravel to the coast. By August one can walk across it."
LAST = "Nobody remembers who built the old bridge, but its stones are numbered, so it must have been taken down once."

PAGES = [
    # 1 plain divs, nothing else
    (f"<div>{LOREM}</div><div>{MORE}</div><div>{LAST}</div>", f"{LOREM} {MORE} {LAST}"),
    # 2 line breaks in the body, old style
    (f"<HTML><BODY BGCOLOR=white><CENTER><H2>The river</H2></CENTER>{LOREM}<BR><BR>{MORE}<BR><BR>{LAST}<HR><CENTER><A HREF=index.html>Back</A> | <A HREF=map.html>Map</A></CENTER></BODY></HTML>", f"The river {LOREM} {MORE} {LAST}"),
    # 3 table layout
    (f"<table width=100%><tr><td colspan=2><img src=logo.gif></td></tr><tr><td><a href=1>Home</a><br><a href=2>News</a><br><a href=3>Contact</a></td><td><h1>The river</h1><p>{LOREM}</p><p>{MORE}</p></td></tr><tr><td colspan=2>Copyright 1999 River Board</td></tr></table>", f"The river {LOREM} {MORE}"),
    # 4 unclosed p and li
    (f"<body><ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul><h1>Banks<p>{LOREM}<p>{MORE}<ul><li>Hops are planted in March.<li>They are cut in September.</ul><p>{LAST}</body>", f"Banks {LOREM} {MORE} Hops are planted in March. They are cut in September. {LAST}"),
    # 5 links as content
    (f"<article><h1>Sources</h1><p>{LOREM}</p><ul><li><a href=x>Read the plan</a></li><li><a href=y>See the map of 1850</a></li></ul><p>{LAST}</p></article>", f"Sources {LOREM} Read the plan See the map of 1850 {LAST}"),
    # 6 hostile attributes
    (f"<div data-y=\"12px\" class='a>b' onclick=\"x('</div>')\"><p title='1 < 2'>{LOREM}</p><p>{MORE}</p></div>", f"{LOREM} {MORE}"),
    # 7 unclosed title
    (f"<html><head><title>The river<meta charset=utf-8></head><body><p>{LOREM}</p><p>{MORE}</p></body></html>", f"{LOREM} {MORE}"),
    # 8 unclosed script in the head
    (f"<html><head><script>var a = 1;</head><body><p>{LOREM}</p><p>{LAST}</p></body></html>", f"{LOREM} {LAST}"),
    # 9 math, object and canvas in the article
    (f"<main><p>{LOREM}</p><p>The flow is <math><mi>q</mi><mo>=</mo><mi>v</mi></math> per second.</p><object data=m.swf>A drawing of the bridge, seen from the south.</object><p>{LAST}</p></main>", f"{LOREM} The flow is q=v per second. A drawing of the bridge, seen from the south. {LAST}"),
    # 10 definition list
    (f"<div id=wiki><h1>Terms</h1><p>{LOREM}</p><dl><dt>Weir</dt><dd>A low dam that raises the water.</dd><dt>Ford</dt><dd>A place where one can wade.</dd></dl></div><div id=ft>&copy; 2012 Hill Press</div>", f"Terms {LOREM} Weir A low dam that raises the water. Ford A place where one can wade."),
    # 11 sections in a main, with header and footer
    (f"<header><a href=/>River Times</a></header><main><section><h2>Upstream</h2><p>{LOREM}</p></section><section><h2>Downstream</h2><p>{MORE}</p></section></main><footer><p>Published by the River Times. All rights reserved.</p></footer>", f"Upstream {LOREM} Downstream {MORE}"),
    # 12 comments under a blog post
    (f"<div class=post><h2>A walk</h2><p>{LOREM}</p><p>{MORE}</p></div><div id=comments><h3>2 comments</h3><div class=comment><b>Ann</b><p>I walked there last year and it was lovely.</p></div><div class=comment><b>Bo</b><p>Which bus goes there?</p></div></div>", f"A walk {LOREM} {MORE}"),
    # 13 sidebar with text
    (f"<div id=content><p>{LOREM}</p><p>{MORE}</p><p>{LAST}</p></div><div id=sidebar><h3>About</h3><p>We are a small club of walkers and write about rivers.</p><ul><li><a href=a>Archive</a><li><a href=b>Links</a></ul></div>", f"{LOREM} {MORE} {LAST}"),
    # 14 cookie notice first
    (f"<div class='cookie-banner'><p>We use cookies to improve your visit. By going on you agree to this.</p><button>Accept</button></div><article><h1>Hops</h1><p>{LOREM}</p><p>{LAST}</p></article>", f"Hops {LOREM} {LAST}"),
    # 15 nested wrappers
    (f"<div><div><div><div><nav><a href=a>A</a> <a href=b>B</a></nav><div><div><h1>Deep</h1><div><p>{LOREM}</p></div><div><p>{MORE}</p></div></div></div></div></div></div></div>", f"Deep {LOREM} {MORE}"),
    # 16 pre and code
    (f"<div class=markdown><h1>Gauge</h1><p>{LOREM}</p><pre>level = read(3)\n  print(level)</pre><p>{LAST}</p></div>", f"Gauge {LOREM} level = read(3) print(level) {LAST}"),
    # 17 data table in the article
    (f"<article><p>{LOREM}</p><table><tr><th>Year</th><th>Level</th></tr><tr><td>1990</td><td>3.1 m</td></tr><tr><td>1991</td><td>2.8 m</td></tr></table><p>{MORE}</p></article><aside><a href=q>More on rivers</a></aside>", f"{LOREM} Year Level 1990 3.1 m 1991 2.8 m {MORE}"),
    # 18 block quote and figure
    (f"<article><h1>Stones</h1><figure><img src=a.jpg><figcaption>The bridge in winter.</figcaption></figure><p>{LOREM}</p><blockquote>{LAST}</blockquote><p>{MORE}</p></article>", f"Stones The bridge in winter. {LOREM} {LAST} {MORE}"),
    # 19 advert inside the article
    (f"<article><p>{LOREM}</p><div class=advertisement>Buy boots now at half price!</div><p>{MORE}</p></article>", f"{LOREM} {MORE}"),
    # 20 social buttons and by-line
    (f"<article><h1>Barges</h1><p>{LOREM}</p><p>{MORE}</p><div class=share-buttons><a href=f>Share</a> <a href=t>Tweet</a></div></article><div class=newsletter>Get our letter every week. <input><button>Sign up</button></div>", f"Barges {LOREM} {MORE}"),
    # 21 upper case and entities
    (f"<BODY><H1>R&eacute;sum&eacute; &#8212; 1 &lt; 2</H1><P>{LOREM}</P><P>A&nbsp;B &amp; C are &quot;gauges&quot;, as one says there.</P></BODY>", f"Résumé — 1 < 2 {LOREM} A B & C are \"gauges\", as one says there."),
    # 22 spans as blocks
    (f"<div class=story><div><span>{LOREM}</span></div><div><span>{MORE}</span></div></div><div class=footer><span>&copy; Times</span></div>", f"{LOREM} {MORE}"),
    # 23 breadcrumb and pager around
    (f"<div class=breadcrumbs><a href=/>Home</a> &gt; <a href=/r>Rivers</a></div><h1>Weirs</h1><div><p>{LOREM}</p><p>{MORE}</p></div><div class=pager><a href=1>Previous</a> <a href=3>Next</a></div>", f"Weirs {LOREM} {MORE}"),
    # 24 form after the text
    (f"<section><h2>Ask us</h2><p>{LOREM}</p><p>{LAST}</p></section><form action=/s><label>Your mail</label><input><p>We will never pass on your address.</p><button>Send</button></form>", f"Ask us {LOREM} {LAST}"),
    # 25 other script
    ("<nav><a href=a>Главная</a> <a href=b>Новости</a></nav><article><h1>Река</h1><p>Река берёт начало в холмах над городом, и после войны её дважды перегораживали плотиной.</p><p>Весной вода стоит высоко, и по ней ходят баржи с гравием.</p></article><footer>© 2020 Газета</footer>", "Река Река берёт начало в холмах над городом, и после войны её дважды перегораживали плотиной. Весной вода стоит высоко, и по ней ходят баржи с гравием."),
    # 26 without any markup
    (f"{LOREM}\n\n{MORE}", f"{LOREM} {MORE}"),
    # 27 hidden parts
    (f"<noscript>Turn on scripts.</noscript><article><p>{LOREM}</p><script>if (1 < 2) document.write('<p>no</p>')</script><style>p {{ x: y }}</style><p>{MORE}</p><svg><text>axis</text></svg><template><p>later</p></template></article>", f"{LOREM} {MORE}"),
    # 28 details
    (f"<main><h1>Questions</h1><details><summary>Where does it rise?</summary><p>{LOREM}</p></details><details><summary>Can one walk?</summary><p>{MORE}</p></details></main><footer><a href=i>Imprint</a></footer>", f"Questions Where does it rise? {LOREM} Can one walk? {MORE}"),
    # 29 link-heavy text
    (f"<div id=mw-content><p>The <a href=r>river</a> rises in the <a href=h>hills</a> above the <a href=t>town</a>, and it was dammed <a href=d>twice</a> since the <a href=w>war</a>.</p><p>{LAST}</p></div><div id=catlinks><a href=c1>Rivers</a> | <a href=c2>Hills</a></div>", f"The river rises in the hills above the town, and it was dammed twice since the war. {LAST}"),
    # 30 unclosed article and a footer without a tag of its own
    (f"<article><h1>End</h1><p>{LOREM}</p><p>{MORE}<div class=foot>Copyright © 2019 Hill Press | Terms | Privacy</div>", f"End {LOREM} {MORE}"),
]
