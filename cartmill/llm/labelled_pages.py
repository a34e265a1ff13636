"""Hand-labelled pages from which the extraction weights are counted: the main text stands between [[ and ]]."""

PAGES = (
    """<html><head><title>River news</title></head><body><header><a href="/">Home</a> <a href="/all">All</a></header>
<div id="wrap"><article>[[<h1>Bridge opens</h1><p>The new bridge over the river opened on <b>Monday</b> after four
years of work.</p><p>Traffic was light. The mayor walked first, and many people followed.</p><ul><li>It is 300 metres
long</li><li>It cost less than planned</li></ul><p>A second bridge is planned.</p>]]</article></div>
<div class="x2"><ul><li><a href="/a">More</a></li><li><a href="/b">Older</a></li></ul></div>
<footer>Copyright River news</footer></body></html>""",
    """<html><body><div><a href="/">Start</a> | <a href="/p">Plants</a> | <a href="/s">Soil</a></div><div><div>
[[<h2>Growing beans</h2><p>Beans like warm soil. Wait until the nights are mild before you sow them, and keep the bed
moist.</p><p>They climb, so give them poles.<br>Two metres will do.</p><blockquote>Never sow beans before the middle of
May.</blockquote><p>Harvest <i>often</i>, as that keeps them bearing until autumn.</p>]]</div><div><h4>Popular</h4><a
href="/1">Ten tomatoes</a><a href="/2">Compost</a></div></div><div><span>Imprint</span></div></body></html>""",
    """<html><body><nav><ul><li><a href="/x">Sport</a></li><li><a href="/y">Culture</a></li></ul></nav><main><article>
[[<h1>Late win</h1><p>It took until the last minute, but the home side won a game that had seemed lost at half
time.</p><div class="ad">Buy shoes now</div><p>The coach praised his team's patience. "We waited for our chance," he
said after the match, "and it came."</p><p>They play again on Saturday.</p>]]</article><section class="comments"><p>Great
game, I was there!</p><p>We were lucky, to be honest.</p></section></main><footer><p>All rights reserved</p></footer>
</body></html>""",
    """<html><body><table><tr><td><a href="/i">Index</a></td><td><a href="/m">Mail</a></td></tr></table><table><tr><td>
<div>[[<p>When I bought the old house I did not know how much work it would be. The roof leaked, the windows were rotten
and mice lived in the kitchen.</p><p>Step by step we mended it all.</p><p>Today I would not live anywhere
else.</p>]]</div></td><td><div><a href="/n1">Roofs</a><br><a href="/n2">Windows</a></div></td></tr></table><hr><div>
Written by hand</div></body></html>""",
    """<html><body><div class="cookie-notice">We use cookies. <button>Agree</button></div><section><article><header>
[[<h1>A short history of tea</h1></header><h2>Beginnings</h2><p>Tea was a medicine before it was a drink.</p><h2>Trade
</h2><p>Ships carried it around the world, and <a href="/w">wars</a> were fought over it.</p><ol><li>Green tea</li>
<li>Black tea</li></ol><p>It is still the most common drink after water.</p>]]</article></section><aside><h3>Read on</h3>
<p>Coffee came later.</p></aside><form><label>Mail</label><input></form></body></html>""",
    """<html><body><div><div><span>Tuesday</span></div><div><a href="/l">Log in</a></div></div><div><div><section>
[[<p>The committee met for the third time this year and could not agree on a plan for the station.</p><p>Two members
left early.</p><pre>Motion 14 was postponed.</pre><p>Its next meeting will be in public, which has not happened for a
decade.</p>]]</section></div><div><div><a href="/r1">Roads</a></div><div><a href="/r2">Rails</a></div><div><a
href="/r3">Rates</a></div></div></div></body></html>""",
    """<html><body><div><div><a href="/">Atlas</a></div></div><div>[[<div>The island has no harbour.</div><div>Boats
land on the beach when the sea allows it,<br>which it seldom does<br>in winter.</div><section><h3>People</h3><div>Some
<span>eighty people</span> stay all year.</div><div>They keep sheep and mend nets.</div></section><table><tr><th>Year
</th><th>Sheep</th></tr><tr><td>1950</td><td>about 400</td></tr><tr><td>2000</td><td>about 250</td></tr></table><figure>
<img src="i.png"><figcaption>The beach in May</figcaption></figure><hr><div>A boat goes twice a week.<br>It takes an
hour.</div>]]</div><div><a href="/2">Next island</a></div></body></html>""",
    """<html><body><div><span>Menu</span> <span><a href="/r">Recipes</a></span></div><main><div><div>[[<h1>Pea soup</h1>
<div><p>Soak the peas overnight.</p></div><div><p>Boil them with <em>one</em> onion and <strong>two</strong> carrots.
<br>Stir now and then.<br>Add water if it gets thick.</p></div><dl><dt>Peas</dt><dd>half a pound</dd><dt>Onions</dt><dd>
one</dd></dl><h5>Serving</h5><p>Serve it with <code>bread</code> and <u>butter</u>. It tastes better on the second
day.</p>]]</div></div></main><div><div><a href="/q">Bean soup</a></div></div></body></html>""",
)
