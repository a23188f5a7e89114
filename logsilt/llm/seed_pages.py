"""Hand-labelled pages: parts that many sites have and a corpus may lack.

``data-label`` says whether an element and all below it are content. Without it a page counts as other.
"""

SEED_PAGES = (
    """<html><body><header class="masthead"><a href="/">The Site</a><p>News for all, every day.</p></header>
<nav class="menu"><ul><li><a href="/a">Home</a></li><li><a href="/b">World</a></li><li>Sport</li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better. Please accept.</p><button>Accept</button></div>
<div id="content" data-label="content"><h1>A long road home</h1><p>It was late when the train came, and nobody had
waited for it. The lamps were out, the rain had stopped, and a dog slept under the bench by the door of the station,
where the last passengers had left their papers and a paper cup, half full, and still warm to the touch of a hand.</p>
<p>Nobody knew.</p><blockquote>So we went on.</blockquote><ul><li>One thing was clear.</li><li>Another was not.</li></ul>
<div class="ad" data-label="other">Buy two, get one free. Today only!</div>
<p>In the morning they took the <a href="/x">road along the river</a>, and it was good, for a while.</p></div>
<aside class="sidebar"><h3>Related</h3><p>More stories that you may like, chosen for you.</p></aside>
<div id="comments" class="comments"><h3>Comments</h3><div class="comment"><p>I liked this a lot, thank you. Great work!</p></div>
<div class="comment"><p>Not sure that I agree, but it was well said, and it made me think about it for a while.</p></div></div>
<form class="search"><p>Search this site.</p></form><footer><p>&copy; The Site. All rights reserved.</p></footer></body></html>""",
    """<html><body><div class="topbar">Welcome, guest.</div><div class="nav"><a href="/1">One</a> <a href="/2">Two</a></div>
<article data-label="content"><header data-label="other"><p>By a writer, in the news.</p></header><h2>On bread</h2>
<p>Flour, water, salt and time: there is not much more to it, they say, and yet no two loaves are the same. The
dough tells you when it is ready, if you learn to listen, and that takes years, or one good teacher, or luck.</p>
<p>Yes.</p><table><tr><td>Flour</td><td>500 g.</td></tr><tr><td>Water</td><td>350 g.</td></tr></table><pre>Bake it well.</pre>
<figure><figcaption>A loaf.</figcaption></figure><section><h3>Notes</h3><p>Old flour is dry, so add water.</p></section>
<nav data-label="other"><ul><li><a href="#a">Top</a></li></ul></nav><aside data-label="other"><p>Read our other story, too.</p></aside>
<div class="newsletter" data-label="other"><p>Get our letter every week. It is free, and it is good.</p></div>
<footer data-label="other"><p>Filed under food, by the editors.</p></footer></article>
<section class="comments"><article class="comment"><p>My grandmother made it so, with less salt, and more patience.</p></article></section>
<div class="related"><ul><li><a href="/r">On butter</a></li><li><a href="/s">On jam, and what to do with it</a></li></ul></div>
<div class="popup"><p>Subscribe now, and read all we have. It takes a minute.</p></div>
<div class="footer"><p>Contact us, or write to the editors. &copy; Bread.</p></div></body></html>""",
    """<html><body><div id="header"><h1>My pages</h1></div><ul class="breadcrumb"><li><a href="/">Start</a></li></ul>
<div class="banner"><p>Sale! All must go, this week only.</p></div><main data-label="content"><h1>The hill</h1><p>From
the top you see three villages and, on a clear day, the sea. We walked up in spring, when the grass was wet, and again
in autumn, when it was not, and the second time was better, because we knew the way and had time to look around.</p>
<p>Go there.</p><div><p>It is not far, and there is a bus, too.</p></div><div class="share" data-label="other">Share this story</div>
<div class="advertisement" data-label="other"><p>The best boots for every hill, now cheaper.</p></div></main>
<div class="widget"><h4>Popular</h4><ol><li><a href="/p">The lake</a></li><li><a href="/q">The wood, in winter</a></li></ol></div>
<div class="respond"><form><label>Your comment</label><textarea></textarea></form></div>
<div class="disclaimer"><p>All that is said here is our own view.</p></div><footer>&copy; My pages &middot; by hand.</footer></body></html>""",
    """<html><body><div class="page"><div class="menu"><ul><li>Start</li><li>About</li></ul></div><div class="post" data-label="content">
<h1>Plain</h1>Some pages have no paragraphs at all, only text that runs on in a box, with breaks where the writer thought
of one,<br>and it should be kept as well, for it is what the page is about, whatever its tags may be called.
<div>And a box within the box.</div></div><div class="sponsored"><div>This was paid for by a friend of ours.</div></div>
<div class="side"><div>What others read, and what they thought of it.</div></div></div></body></html>""",
    """<html><body data-label="content"><h1>Bare</h1><p>This page has no boxes. It is text from top to bottom, and all of
it is meant to be read. There are such pages still, mostly old ones, and they load fast. Nobody minds.</p><p>The end.</p>
<div class="footer" data-label="other"><a href="/">Back to the start</a></div></body></html>""",
)
