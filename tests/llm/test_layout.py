"""Packing, sharding, URL rules, HTML extraction and decontamination."""

import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_texts import prose
from tokenizers import Tokenizer

import corpus_pipeline
from linguamart.llm import jumpshards, leaks, mainblocks, packing, queries, urlrules

PATH = public_tokenizers.path("byte_bpe_50k.json")


def token_ids(text):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check_packed(rows, found, size):
    want = Counter()
    for doc_id, text in rows:
        ids = np.asarray(token_ids(text), "<u4")
        at = 0
        while at < len(ids):
            length = (len(ids) % size or size) if not at else size
            want[doc_id, at, length, zlib.crc32(ids[at:at + length].tobytes())] += 1
            at += length
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    filled = defaultdict(list)
    for r in found:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
    return len(filled)


def test_packing(frame, odd_rows):
    rows = odd_rows + [(100 + i, prose(1 + 13 * i % 300, i)) for i in range(120)]
    for size in (64, 2048):
        found = packing.pack_documents(frame(rows).repartition(5, "doc_id"), PATH, size).collect()
        used = check_packed(rows, found, size)
        total = sum(r["length"] for r in found)
        assert used <= -(-total // size) * 1.05 + 1
    assert packing.pack_documents(frame([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit(seed):
    """The plan over counts is what best fit over single pieces, longest first, gives."""
    rng = random.Random(seed)
    lengths = [rng.choice([3, 5, 7, 20, 33, 50, rng.randint(1, 100)]) for _ in range(300)]
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(100 - n)
    plan = packing.best_fit(Counter(lengths), 100)
    filled, ranks = defaultdict(list), defaultdict(list)
    for length, rank, number, sequence, offset in plan:
        for k in range(number):
            ranks[length].append(rank + k)
            filled[sequence + k].append((offset, length))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in Counter(lengths).items()}
    assert len(filled) == len(rooms)
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100


def test_encoder_equals_tokenizer():
    rng = random.Random(5)
    letters = [*"ab AB 12 \n\t ' \u0085\x1c\x00\x0b%$#.,!éƀ²½ªsdlv", "'s", "'ll", " the", "<|endoftext|>", "　", "字", "😀", "   "]
    encode = packing.encoder(PATH)
    for _ in range(500):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(30)))
        assert encode(text) == np.asarray(token_ids(text)[:-1], "<u4").tobytes()


@pytest.mark.parametrize("blank", [" ", "\n"])
def test_encoder_takes_long_white_space(blank):
    encode = packing.encoder(PATH)
    for text in ("a" + blank * 2_000_000 + "b", "a" + blank * 99_999 + "b"):
        same = encode(text) == np.asarray(token_ids(text)[:-1], "<u4").tobytes()
        assert same


def test_special_tokens():
    """As tokenizers' own call with add_special_tokens=False, where the queries ask for it."""
    tokenizer, encode = Tokenizer.from_file(PATH), packing.encoder(PATH, special=True)
    assert encode("end <|endoftext|> here") == np.asarray([437, 220, 50256, 994], "<u4").tobytes()
    for text in ("<|endoftext|>", "字<|endoftext|>", "a <|endoftext|><|endoftext|>\n", "<|endoftext", "plain text"):
        assert encode(text) == np.asarray(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("module", [queries, corpus_pipeline])
def test_queries_ask_for_special_tokens(module, monkeypatch):
    asked = []
    monkeypatch.setattr(packing, "pack_documents", lambda *args, **more: asked.append(more))
    monkeypatch.setattr(queries, "table", lambda *args: None)
    queries.op7(None, None) if module is queries else corpus_pipeline.pack(None, None, None)
    assert asked == [{"special": True}]


def test_sharding(spark, frame, odd_rows):
    rows = odd_rows + [(100 + i, prose(i % 50, i)) for i in range(2000)]
    found = jumpshards.shard_documents(frame(rows).repartition(7)).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == want
    assert {r["law"] for r in found} == {"key"} and len({(r["doc_id"], r["shard"]) for r in found}) == len({r["doc_id"] for r in found})
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) == set(range(16))
    moved = sum(r["grown_shard"] == 16 for r in found)
    assert 0.5 < moved / (len(found) / 17) < 1.6 and max(map(len, slots.values())) < 1.5 * len(found) / 16
    # Growing on from any number of shards moves keys to the new one only.
    keys = spark.range(3000)
    several = keys.select("id", *[jumpshards.jump_shard(keys.id, n).alias(f"s{n}") for n in range(1, 12)]).collect()
    for n in range(1, 11):
        assert all(r[f"s{n + 1}"] in (r[f"s{n}"], n) for r in several)
    assert jumpshards.shard_documents(frame([])).count() == 0


def test_shard_files(spark, frame, tmp_path):
    rows = [(i, prose(5, i)) for i in range(200)]
    placed = jumpshards.shard_documents(frame(rows), 4)
    jumpshards.write_shards(frame(rows), placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["row"]["doc_id"], r["row"]["text"]) for r in back.collect()) == rows
    assert {(r["row"]["doc_id"], r["shard"], r["slot"]) for r in back.collect()} == {(r["doc_id"], r["shard"], r["slot"]) for r in placed.collect()}


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def test_url_rules(spark):
    link = lambda href: f"<html><head><LINK rel='canonical' href=\"{href}\"></head>"
    pages = [
        (1, "https://a.example.net/en/1?x", None, "a.example.net", "/en/1", "example.net/en/", "allow"),
        (2, "https://A.Example.NET/de/1#y", "", "a.example.net", "/de/1", "net/", "block"),
        (3, "http://example.net", "", "example.net", "", None, "allow"),
        (4, "x://notexample.com/de/1", "", "notexample.com", "/de/1", None, "allow"),
        (5, "x://b.example.com/de/1", "", "b.example.com", "/de/1", "example.com/de/", "block"),
        (6, None, "", "", "", None, "allow"), (7, "no address", "", "", "", None, "allow"), (None, "", None, "", "", None, "allow"),
        (8, "http://x.org/fr/?a://b", "", "x.org", "/fr/", "org/fr/", "allow"),
        (9, "http://x.org?/fr/", "", "x.org", "", None, "allow"),
        # A chain of aliases to a blocked address, over a refresh and a relative link.
        (10, "http://m.org/1", link("https://m.org/2"), "m.org", "/1", None, "block"),
        (11, "https://m.org/2", "<meta http-equiv=refresh content='0; URL=/dir/3'>", "m.org", "/2", None, "block"),
        (12, "http://m.org/dir/3#top", link("//spam.net/x?a=1&amp;b=2"), "m.org", "/dir/3", None, "block"),
        # An allow among the aliases goes first; a rule of one's own before all.
        (13, "http://k.org/1", link("http://spam.net/k"), "k.org", "/1", None, "allow"),
        (14, "http://k.org/fr/2", link("http://k.org/1"), "k.org", "/fr/2", "org/fr/", "allow"),
        (15, "http://spam.net/k", "", "spam.net", "/k", "net/", "block"),
        (15, "http://spam.net/k", "", "spam.net", "/k", "net/", "block"),
        (16, "http://far.org/1", "", "far.org", "/1", None, "block"),
    ]
    df = spark.createDataFrame([(*p[:3], "n", "v") for p in pages], "page_id long, url string, html string, name string, verdict string")
    moved = spark.createDataFrame([("http://far.org/1", "http://q.net/"), (None, "x"), ("http://hub.org/", "http://hub.org/")], "source string, target string")
    found = urlrules.filter_urls(df, RULES, moved)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(((p[0], *p[3:]) for p in pages), key=str)
    assert urlrules.filter_urls(df.limit(0), RULES).count() == 0
    assert urlrules.filter_urls(df, []).where("rule is not null").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a>b">One</a><li><a href=/b>Two</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy this thing now please.</div>%s
<aside>Side</aside><div id="comments"><p>First!</p><p>I think so too.</p></div><form><label>Name</label><input></form><footer>&copy; us</footer></body></html>"""


def test_main_text():
    body = "<h1>Head</h1><p><b>A</b>b  &amp;\n c&nbsp;&lt;d&gt;<br><p>Sh.</p><div class='share'>Tweet</div><p>Last <a href=x>link</a> here.</p>"
    want = "Head Ab & c <d> Sh. Last link here."
    assert mainblocks.main_text(PAGE % f"<article>{body}</article>") == want
    assert mainblocks.main_text(PAGE % f"<main>{body}</main>") == want
    # Without an article element the longest stretch between menus and adverts is kept.
    plain = PAGE % f"<div>{body}</div>"
    assert mainblocks.main_text(plain) == want
    assert mainblocks.main_text(f"<article>{body}") == want and mainblocks.main_text(f"<article>{body}</article><footer>&cop") == want
    for empty in (None, "", "<p>", "<nav>x</nav>", "<!--", "<script>x", "<"):
        assert mainblocks.main_text(empty) in ("", "<")
    assert mainblocks.main_text("just text &amp; more") == "just text & more"
    long = "<p>" + "</p><p>".join(prose(20, i) for i in range(3000)) + "</p>"
    assert mainblocks.main_text(PAGE % f"<article>{long}</article>") == re.sub(r"</?p>(?:<p>)?", " ", long).strip()


def test_main_text_drops_nothing_else():
    body = "<h1>Head</h1><p>One two three.</p><h2 id='related-work'>Related work</h2><section id='search-methods'><p>Four five.</p></section>"
    want = "Head One two three. Related work Four five."
    for page in ("<div class='content with-sidebar'>%s</div>", "<div class='elementor-widget'><article>%s</article></div>", "<div class='widget'><main>%s</main></div>",
                 "<div class='widget'>%s</div><div class='ad'>Buy</div>", "<form>%s</form>", "<head><title>T</title><div>%s</div>", "<nav><article>%s</article></nav>"):
        assert mainblocks.main_text(page % body) == want, page
    assert mainblocks.main_text("<article><p>a b</p><p><a href=x>all of it linked</a></p></article>") == "a b all of it linked"
    adverts = "<div class='ad'>Buy</div>" * 4
    assert mainblocks.main_text(f"<p>{prose(9, 1)}</p>{adverts}<p>{prose(8, 2)}</p>{adverts}<p>{prose(9, 3)}</p>") == f"{prose(9, 1)} {prose(8, 2)} {prose(9, 3)}"
    # Comments in articles of their own go where the page has an article besides.
    assert mainblocks.main_text(f"<article>{prose(30, 1)}</article><div id=comments><article>No.</article></div>") == prose(30, 1)


@pytest.mark.parametrize("name", [
    "site-footer", "cookie-banner", "comment-list", "ad-slot", "main-nav", "adSlot2", "sidebar_inner", "primaryMenu", "post-comments", "social-links", "newsletter-box",
])
def test_names_of_several_parts(name):
    text = prose(40, 1)
    for page in ("<article><p>%s</p><div class='x %s'>Gone.</div></article>", "<div><p>%s</p></div><section id='%s'><p>Gone.</p></section>"):
        assert mainblocks.main_text(page % (text, name)) == text
    for other in ("related-work", "search-methods", "with-sidebar", "has-ads", "navigate", "addition", "footerless-page", "commentary"):
        assert mainblocks.main_text(f"<div><p>{text}</p><p class='{other}'>{text}</p></div>") == f"{text} {text}"


def test_long_comments_go():
    text, comments = prose(30, 1), "".join(f"<div><p>{prose(40, i)}</p></div>" for i in range(20))
    for page in (f"<article>{text}</article><div id=comments>{comments}</div>", f"<div><p>{text}</p></div><div id=comments>{comments}</div>",
                 f"<article>{text}<section class=comment-thread>{comments}</section></article>", f"<div><p>{text}</p></div><div id=comments><article>{comments}</article></div>"):
        assert mainblocks.main_text(page) == text


def test_unbalanced_tags_take_linear_time():
    began = time.process_time()
    assert mainblocks.main_text("<div>" * 80_000 + "x" + "</p>" * 80_000 + "<b></i>" * 80_000) == "x"
    assert mainblocks.main_text("<div><a>" * 40_000 + "</div>" * 40_000 + "y") == "y"
    assert time.process_time() - began < 4


@pytest.mark.parametrize("seed", range(20))
def test_stretches(seed):
    """Against sums of every window: lines near text are in a stretch, and a faint one is left out."""
    rng = random.Random(seed)
    length = [rng.choice([0, 0, 0, 1, 5, 30, 400]) for _ in range(rng.randint(1, 60))]
    window, faint = rng.choice([1, 2, 3, 5]), rng.choice([0, 0.1, 0.5])
    sums = [sum(length[max(0, i - window + 1):i + 1]) for i in range(len(length) + window - 1)]
    groups, now = [], []
    for i, x in enumerate(sums + [0]):
        if x:
            now.append(i)
        elif now:
            groups.append(now)
            now = []
    want = {i for g in groups if max(sums[k] for k in g) >= faint * max(sums) for i in range(g[0], g[-1] + 2 - window) if length[i]}
    got = [i for a, b in mainblocks.stretches(np.array(length), window, faint) for i in range(a, b) if length[i]]
    assert got == sorted(want)


def test_distribution_decides_outside_articles():
    """The same words stay in an article, and go as a faint stretch far from the text of a page without one; wide windows reach them."""
    gap = "<div class=ad>Buy</div>" * 4
    page = f"<p>Login</p>{gap}<p>{prose(60, 1)}</p><p>Short.</p><p>{prose(60, 2)}</p>{gap}<p>Top</p>"
    want = f"{prose(60, 1)} Short. {prose(60, 2)}"
    assert mainblocks.main_text(page) == want
    assert mainblocks.main_text(page, window=9) == mainblocks.main_text(f"<article>{page}</article>") == f"Login {want} Top"


def test_extract(spark):
    rows = [(1, "u", PAGE % "<article><p>x y</p></article>"), (None, None, None), (2, "v", ""), (1, "u", PAGE % "<article><p>x y</p></article>")]
    df = spark.createDataFrame([(*r, "t", 5) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    assert sorted(map(tuple, mainblocks.extract(df).collect()), key=str) == sorted([(1, "u", "x y", 3)] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert mainblocks.extract(df.limit(0)).count() == 0


def brute_leaks(docs, items):
    """(doc, item) of texts with an aligned run of 20 words (or the item's, if fewer) of which four fifths are equal."""
    out = set()
    for doc_id, text in docs:
        a = re.findall(r"[^\W_]+", (text or "").lower())
        for item_id, other in items:
            b = re.findall(r"[^\W_]+", (other or "").lower())
            need = min(20, len(b))
            for shift in range(-len(b) + 1, len(a)):
                first = max(0, -shift)
                side = [a[i + shift] == b[i] for i in range(first, min(len(b), len(a) - shift))]
                if b and any(sum(side[i:i + need]) >= 0.8 * need for i in range(len(side) - need + 1)):
                    out.add((doc_id, item_id))
    return out


@pytest.mark.parametrize("size", range(1, 21))
def test_masks_leave_no_overlap_out(size):
    """Every choice of substituted words within the share leaves a mask whole at some place."""
    places = [{at + i for i, c in enumerate(m) if c == "1"} for m in leaks.masks_of([size]) for at in range(size - len(m) + 1)]
    for gone in itertools.combinations(range(size), size - math.ceil(leaks.SHARE * size)):
        assert any(p.isdisjoint(gone) for p in places), gone


def test_substitutions_that_six_words_miss(spark, frame):
    items = [(1, prose(15, 700)), (2, prose(20, 701)), (3, prose(6, 702)), (4, prose(3, 703))]

    def without(text, places):
        return " ".join("xx" if i in places else w for i, w in enumerate(text.split()))

    changed = [without(items[0][1], (2, 7, 9)), without(items[1][1], (5, 7, 13, 15)), without(items[2][1], (1,)), items[3][1]]
    docs = frame([(10 + i, f"aa bb {text} cc dd") for i, text in enumerate(changed)])
    found = leaks.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(10 + i, 1 + i) for i in range(4)]


def test_decontamination(spark, frame, odd_rows):
    items = [(i, prose(16 + 3 * i, 500 + i)) for i in range(10)] + [(10, None), (11, ""), (12, "ka ban"), (None, prose(30, 600)), (0, prose(16, 500))]
    items += [(20 + n, prose(n, 610 + n)) for n in range(1, 7)]

    def changed(text, every):
        return " ".join("XX" if every and i % every == every - 1 else w.title() + "," for i, w in enumerate(text.split()))

    docs = odd_rows + [(100 + i, f"{prose(50, i)} {changed(items[i][1], every)} {prose(30, 80 + i)}") for i, every in enumerate((0, 5, 6, 8, 3, 2, 7, 0, 9))]
    docs += [(120, items[9][1]), (121, f"{prose(9, 5)} {' '.join(items[9][1].split()[:25])} {prose(9, 6)}"), (122, f"a {items[13][1]} b"), (120, items[9][1])]
    benchmark = spark.createDataFrame([(*x, "h") for x in items], "item_id long, text string, item_hash string")
    found = leaks.contaminated(frame(docs), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == brute_leaks(docs, items)
    assert found.count() == len(found.select("doc_id", "item_id").distinct().collect())
    assert leaks.contaminated(frame([]), benchmark).count() == 0 and leaks.contaminated(frame(docs), benchmark.limit(0)).count() == 0
