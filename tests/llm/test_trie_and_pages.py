"""Page extraction, the conversation trie and fill-in-the-middle against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from convspark.llm.fill_in_middle import SkipList, fill_in_middle, restored, token_widths
from convspark.llm.html_blocks import ARTICLE, BESIDE, OPEN, blocks
from convspark.llm.html_extraction import host_of, main_text, repeated_tokens
from convspark.llm.prefix_trie import conversation_trie, ends_digests, list_ranks

PAGES = "page_id long, url string, html string"


def article(html):
    return [text for part, text in blocks(html) if part == ARTICLE]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<article><h1>A &amp; B</h1><p>one\n two&nbsp;three<p>four<br>five</article>", ["A & B", "one two three", "four five"]),
        ("<article>a<div class='ad'>x</div>b<span class=\"share\">y</span>c</article>", ["a", "bc"]),
        ("<main><header><h1>T</h1><p>by</p></header><p>x</p><footer>f</footer><aside>s</aside></main>", ["T", "x"]),
        ("<nav><ul><li>menu<article><p>x</article>", ["x"]),
        ("<aside><article><p>teaser</article></aside><article><p>x</article>", ["x"]),
        ("<article><p>x</p><section id=comments><article><p>me too</article></section></article>", ["x"]),
        ("<article class='comment'>no</article><div class='entry-content'><p>yes</div>", ["yes"]),
        ("<article><script>if (a<b) '</p>'</script><style>p{}</style><p>x &lt;b&gt; &#233;&#x2014; &unknown; 5 < 6</article>", ["x <b> é— &unknown; 5 < 6"]),
        ("<article><p>x<!-- <p>hidden</p> -->y</article>", ["xy"]),
        ("<article><form><p>mail</p><input></form><p>x<button>Go</button></article>", ["x"]),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><dl><dt>e<dd>f</dl></article>", ["a", "b", "c", "d", "e", "f"]),
        ("<body class='has-sidebar'><article><p><b>x<p>y</b></article>", ["x", "y"]),
        ("<article><p>x</p></div></nav></span><p>y", ["x", "y"]),
        ("<article><p title=\"a > b\">x</p><p title='>'>y</article>", ["x", "y"]),
        ("<article></article>", []),
        ("<article><p>cut <a href='", ["cut"]),
        ("<ARTICLE><P>x</P></ARTICLE>", ["x"]),
        ("<article><pre>a\n  b</pre><div role=alert>n</div><div class=cookie-notice>n</div></article>", ["a b"]),
    ],
)
def test_articles(html, want):
    assert article(html) == want


def test_parts_beside_articles():
    page = "<head><title>t</title></head><body><header>h</header><nav>n</nav><div id=sidebar>s</div><div>free</div><p>text</p><footer>f</footer>"
    assert blocks(page) == [(BESIDE, "h"), (BESIDE, "n"), (BESIDE, "s"), (OPEN, "free"), (OPEN, "text"), (BESIDE, "f")]
    assert blocks("") == [] and blocks("no markup  at all") == [(OPEN, "no markup at all")]


@pytest.mark.parametrize("piece", ["<div>", "<b>", "<p title=\"", "<!--", "<a '", "</i>x<i>", "<li>x", "x<", "&amp", "<td>x", "<nav><article>", "<![CDATA[", "<aside><article>", "<p><b>", "<i><div><b></i>"])
def test_long_pages_take_linear_time(piece):
    took = []
    for n in (5_000, 20_000):
        began = time.process_time()
        blocks(piece * n)
        took.append(time.process_time() - began)
    assert took[1] < 8 * took[0] + 0.2


def test_hosts(spark):
    urls = ["http://A.example.com/x", "https://u@b.example:80", "//c", None, "ftp://d?x=http://e/", ""]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(host_of(F.col("url")).alias("h")).collect()
    assert [r.h for r in got] == ["a.example.com", "b.example", "", "", "d", ""]


def test_repeated_tokens(spark):
    r = random.Random(5)
    rows = [(f"h{k % 2}", k, 0, [r.choice("abc") for _ in range(r.randint(0, 40))]) for k in range(30)]
    rows += [("h9", k, 0, list("abcdefghij")) for k in range(3)] + [("h8", 1, 0, list("abcdefgh")), ("h7", 1, 0, list("abcdefgh")), ("h6", 1, 0, list("abcd" * 4))]
    got = {(x.host, x.s1, x.at) for x in repeated_tokens(spark.createDataFrame(rows, "host string, s1 long, s2 long, tokens array<string>"), 8).collect()}
    places = {}
    for h, k, _, t in rows:
        for i in range(len(t) - 7):
            places.setdefault((h, tuple(t[i : i + 8])), []).append((k, i))
    want = {(h, k, i + d) for (h, _), at in places.items() if len({k for k, _ in at}) > 1 for k, i in at for d in range(8)}
    assert got == want and any(h == "h9" for h, *_ in got) and not any(h in ("h8", "h7", "h6") for h, *_ in got)


def test_main_text(spark):
    menu = "<div>All our topics and offers of this week are here for you today</div>"
    page = lambda k: f"<body>{menu}<p>Own text number {k} of the page {k * k} which nobody else has.</p><div>Read our terms before you go on to use what {k} says</div>"
    rows = [(k, "http://x.example/a", page(k)) for k in range(4)] + [(4, "http://x.example/b", page(0))]  # a copy of a page
    rows += [(5, "http://y.example/", page(0)), (6, "http://x.example/", "<nav>All our topics and offers of this week are here for you today</nav><article><p>Marked text that is the same on two pages of a host.</article>")]
    rows += [(7, "http://x.example/", rows[-1][2]), (7, "http://x.example/", rows[-1][2]), (8, None, None), (None, "http://x.example/", ""), (9, "http://x.example/", "<article>" + "long " * 200_000 + "</article>")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES + ", text string, host string").repartition(3)
    got = {}
    for x in main_text(df).collect():
        got.setdefault(x.page_id, []).append(x.text)
    for k in range(4):
        # The end of the last block (what ... says) has too few tokens in common; ten before it are repeated.
        assert got[k] == [f"Own text number {k} of the page {k * k} which nobody else has.\n\n{k} says"]
    assert got[4] == got[0]
    assert got[5][0].startswith("All our topics")  # no other page of that host repeats it
    marked = "Marked text that is the same on two pages of a host."
    assert got[6] == [marked] and got[7] == [marked, marked] and got[8] == [""] and got[None] == [""]
    assert got[9] == [("long " * 200_000).strip()]
    assert main_text(spark.createDataFrame([], PAGES)).collect() == []


def naive_trie(rows, heads, group):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        full[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, s in full.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = set()
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        children = [k for k in below if len(k) == len(key) + 1]
        leaves = sum(not any(j[: len(k)] == k and len(j) > len(k) for j in below) for k in below)
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in members if len(full[c]) == len(key))))
        out.add((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("heads, group, remainder", [(6, 100, 1000), (3, 7, 2), (6, 5, 50)])
def test_trie(spark, heads, group, remainder):
    r = random.Random(heads)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "bb", "ü漢", None, ""])) for c in range(-3, 60) if c % 11 for t in range(r.randint(1, 6))]
    rows += [(60, None, "user", "null turn"), (60, 3, "user", "b"), (60, 3, "user", "a"), (60, 3, "user", "a"), (None, 1, "user", "nobody's")]
    rows += [(61, t, "user", f"long conversation {t}") for t in range(300)] + [(62, 0, "user", "x" * 100_000)]
    df = spark.createDataFrame([(*x, "z", 1) for x in rows], TURNS + ", depth string, id int").repartition(3)
    got = {tuple(x) for x in conversation_trie(df, heads, group, remainder).collect()}
    assert got == naive_trie(rows, heads, group)


def test_empty_trie(spark):
    assert conversation_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_turnless_conversations(spark):
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1)
    rows = [(c, 0, "user", "its only turn, before which nothing is given")]
    got = [tuple(x) for x in conversation_trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert got == list(naive_trie(rows, 6, 100)) and got[0][1] == 0


def test_list_ranks(spark):
    order = list(range(500))
    random.Random(1).shuffle(order)
    w = {a: (a % 3, a % 7) for a in order}
    rows = [(a, order[k - 1] if k else None, order[k + 1] if k < 499 else None, *w[a]) for k, a in enumerate(order)]
    got = {x.arc: (x.leaves, x.saved) for x in list_ranks(spark.createDataFrame(rows, "arc long, prev long, next long, leaves long, saved long"), 3).collect()}
    x = y = 0
    for a in order:
        x, y = x + w[a][0], y + w[a][1]
        assert got[a] == (x, y)


def test_ends_of_a_hot_node(spark):
    ids = list(range(-50, 5000, 3))
    df = spark.createDataFrame([(1, i) for i in ids] + [(2, 7)], "key long, conv_id long").repartition(5)
    got = {x.key: x.ends_sha256 for x in ends_digests(df, 100).collect()}
    assert got == {1: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), 2: hashlib.sha256(b"7").hexdigest()}


def naive_fim(doc_id, text):
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "", re.S)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    n, text = len(tokens), text or ""
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark, clashing, odd, empty):
    r = random.Random(3)
    texts = ["", None, "a", "<P>", "x<S>", "<M", "<", "<<S", "a<P", "ß漢😀é b", "\n\t\r\n", "word " * 50_000, "a" * 100_000, "." * 100_000]
    rows = [(k, texts[k % len(texts)]) for k in range(80)] + [(k, "".join(r.choice("ab <SPM>é") for _ in range(30))) for k in range(80, 300)] + [(None, "no id"), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame([(*x, "c") for x in rows], "doc_id long, text string, fim string").repartition(3)
    out = fill_in_middle(df).withColumn("back", restored(F.col("fim_text"), F.col("fim_form"))).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(((x.doc_id, x.text, x.fim_n, x.fim_form, x.fim_prefix_chars, x.fim_middle_chars, x.fim_text) for x in out), key=key) == sorted(((d, t, *naive_fim(d, t)) for d, t in rows), key=key)
    assert all(x.back == (x.text or "") for x in out)
    assert {x.fim_form for x in out} == {"plain", "spm", "psm"}
    assert fill_in_middle(empty).collect() == []
    assert fill_in_middle(clashing).count() == odd.count()


def test_skip_list():
    r = np.random.default_rng(2)
    for n in (0, 1, 2, 4, 5, 17, 1000, 40_000):
        widths = r.integers(1, 9, n)
        lanes, sums = SkipList(widths), np.concatenate(([0], np.cumsum(widths)))
        for rank in {0, n, n // 2, n // 3, max(0, n - 1)}:
            assert lanes.code_points_at(rank) == sums[rank]
        assert len(lanes.lanes) <= 1 + 2 * len(bin(n))
    assert token_widths("ab, é漢cd\n").tolist() == [2, 1, 1, 1, 1, 2, 1]
