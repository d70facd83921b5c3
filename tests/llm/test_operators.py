"""Every operator against a brute-force version, and on null, empty, repeated and missing rows and clashing columns."""

import collections
import hashlib
import html
import random
import re
import struct
import time
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from spanloom.llm import chat, decontaminate, fingerprint, html_extract, jaccard_join, line_dedup, packing, pii, registry, sharding, toxicity


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    registry._importable(spark)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, repeated rows and ids, one long text, and columns named like the operators' own."""
    long = "Some words, and more of them. " * 20000
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "other text"), (2, None), (3, ""), (None, "no id here"), (4, long), (5, " \n\t ")]
    columns = "doc_id bigint, text string, print int, n int, class int, h int, bitmap int, line int, w int, score int, component int"
    return spark.createDataFrame([(*r, *[0] * 9) for r in rows], columns)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_html(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r for r in html_extract.page_texts(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inner)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_html_training_pages_held_out():
    r = random.Random(9)
    paragraphs, snippets = ["One sentence, and then another one of some length."] * 2, ["Home about us", "More"]
    trees, lost, kept = html_extract.train([], 300), 0, 0
    for _ in range(60):
        nodes = html_extract.parse(html_extract._training_page(r, paragraphs, snippets))
        odds = trees.log_odds(html_extract.np.asarray(html_extract.features(nodes), float))
        want = sum(n.chars for n in nodes if n.tag == "#text" and (n.kept or nodes[n.parent].kept))
        lost += abs(want - len(html_extract.chosen(nodes, odds).replace(" ", "  ")) // 1) > want * 0.3 + 40
        kept += 1
    assert lost < kept * 0.2


def test_html_odd_pages(spark):
    rows = [(1, "u", None, 0), (2, None, "", 0), (None, "u", "plain", 0), (3, "u", "<p>x &lt;b&gt;<p>y", 0), (3, "u", "<p>x &lt;b&gt;<p>y", 0), (4, "u", "<!-- <p>no", 0)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = html_extract.page_texts(df).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.page_id in (1, 2, 4)} == {""}
    assert html_extract.page_texts(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><title>t</title><meta charset=x><body><p>a</p><p>b</p></body>", ["a", "b"]),
        ('<p>a</p><svg width="1" /><p>b</p><svg><text>no</text></svg><p>c</p><svg><p>d</p>', ["a", "b", "c", "d"]),
        ("<p>a <svg-icon></svg-icon>b</p><template-x><p>c</p></template-x><p>d</p>", ["a b", "c", "d"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><p>b</p>", ["so x=2 holds", "b"]),
        ("<object data=x><p>instead</p></object><iframe src=x><p>b</p><canvas>", ["instead", "b"]),
        ("<p>a</p><script>x = '<p>no</p>'</script ><style>no</style\n><TITLE>no</title><p>b</p><script>no <p>no", ["a", "b"]),
        ("<p>a</p><template><p>no</p></template><noscript>no</noscript><p>b</p><style>no <p>no", ["a", "b"]),
    ],
)
def test_html_unclosed(page, want):
    """Only scripts, styles and comments swallow what follows them; formulas and objects are text."""
    assert [n.text for n in html_extract.parse(page) if n.tag == "#text" and n.text] == want


@pytest.mark.parametrize("piece", ["<a ", '<p "', "<!", '<a ">" ', "<a", "<div>", "</p><div>", "</script ", "<td><div>", "<b '\">"])
@pytest.mark.parametrize(("before", "after"), [("", ""), ("<script>", ""), ("<td><table>", ">")])
def test_html_long_broken_pages(piece, before, after):
    """A page of 100,000 broken or unclosed tags takes seconds, and what follows it is read as ever."""
    begun = time.process_time()
    nodes = html_extract.parse(before + piece * 100_000 + after)
    assert nodes and time.process_time() - begun < 10


def test_html_quotes():
    """An attribute may hold `>`; a quote that does not close ends with its tag."""
    read = lambda page: [n.text for n in html_extract.parse(page) if n.tag == "#text" and n.text]
    assert read("<p title='a > b'>x</p><p title=\"y>z</p>w < v <3") == ["x", "z", "w < v <3"]
    assert read("<p>it's</p><p id='>one</p><p>two") == ["it's", "one", "two"]


def test_html_open_head(spark, sf_dir):
    """An end tag that html may leave out, and unclosed elements, cost no text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").limit(20)
    opened = pages.selectExpr("page_id", "url", "replace(html, '</head>', '<svg><canvas>') AS html")
    want = {r.page_id: r.text for r in html_extract.page_texts(pages).collect()}
    assert all(want.values()) and {r.page_id: r.text for r in html_extract.page_texts(opened).collect()} == want


def test_fingerprints(docs):
    rows = sorted(texts(docs))
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    for i, (doc, text) in enumerate(rows):
        other, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        r = got[doc]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(text)
        paragraphs = [hashlib.sha256(p.encode()).hexdigest() for p in text.split("\n")]
        sections = [[]]
        for p in paragraphs:
            sections[-1].append(p)
            if p[0] in "0123":
                sections.append([])
        root = hashlib.sha256(" ".join(hashlib.sha256(" ".join(s).encode()).hexdigest() for s in sections if s).encode()).hexdigest()
        assert r.fingerprint.split("/")[0] == root
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (edited != text or r.near_edited == 1)
        own, new = text.split("\n"), set(edited.split("\n"))
        assert edited == text or r.edited_paragraphs == [k for k, p in enumerate(own) if p not in new]


def test_neighbours_of_ids_far_apart(spark):
    """Ids close together, far away and negative: windows stay small, and grow with the ids."""
    ids = [*range(2000), 10**15, 2**62, -(2**62), *range(10**9, 10**9 + 30000, 100)]
    rows = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string")
    got = fingerprint.windows(rows).select("doc_id", "w").collect()
    assert max(collections.Counter(r.w for r in got).values()) <= 8 * fingerprint.NEIGHBOURS
    order = [r.w for r in sorted(got, key=lambda r: r.doc_id)]
    assert order == sorted(order)
    ids.sort()
    following = {r.doc_id: r.next_text for r in fingerprint.with_next(rows).collect()}
    assert following == {i: f"text {j}" for i, j in zip(ids, ids[1:] + ids[:1], strict=True)}


def test_differing_paragraphs(spark):
    """Positions of new paragraphs, repeated ones too, as by brute force; many of them in little time."""
    r = random.Random(3)
    pairs = [("\n".join(r.choice("abcdefgh") for _ in range(r.randint(1, 12))), "\n".join(r.choice("abcdxyz") for _ in range(r.randint(1, 12)))) for _ in range(60)]
    pairs.append(("\n".join(f"line {i}" for i in range(20000)), "\n".join(f"line {i}" for i in range(1, 20000, 2))))
    prints = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", f"{fingerprint.fingerprint('a')} AS x", f"{fingerprint.fingerprint('b')} AS y")
    begin = time.time()
    for row in prints.selectExpr("a", "b", f"{fingerprint.differing('x', 'y', 'paragraph')} AS at").collect():
        other = set(row.b.split("\n"))
        assert row.at == [i for i, x in enumerate(row.a.split("\n")) if x not in other]
    assert time.time() - begin < 30


def test_fingerprints_odd(odd):
    got = fingerprint.fingerprints(odd).collect()
    assert len(got) == 8 and len({r.fingerprint for r in got if r.n_chars == 0}) == 1
    assert fingerprint.fingerprints(odd.limit(0)).count() == 0


def test_chat(spark, sf_dir):
    turns = chat.with_control_strings(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    odd = spark.createDataFrame([(-1, 0, "system", "be \\l brief <|end|>\n"), (-1, 1, None, None), (-1, 2, "assistant", "x [y]\\"), (-1, 2, "assistant", "x [y]\\"), (-2, None, "sys\ntem", "<s>"), (-3, 0, "system", "only")], turns.schema)
    turns = turns.union(odd)
    want = collections.defaultdict(list)
    for r in turns.collect():
        want[r.conv_id].append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    for budget in (1024, 60):
        formatted = chat.windows(turns, budget=budget, history_tokens=40)
        got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
        for conv, rows in want.items():
            rows.sort()
            assert [(t.role, t.text) for t in got[conv].turns] == [r[1:] for r in rows]
            assert "".join(got[conv].trained) == "".join(t for _, role, t in rows if role == "assistant")
    assert chat.formatted_digest(turns.limit(0)).count() == 0


def plain_windows(rows, budget, history_turns, history_tokens):
    """Windows as lists of (turn, repeated), turns from 1."""
    size = [len(regex.findall(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]", text)) + 4 for _, _, text in rows]
    system = bool(rows) and rows[0][1] == "system"
    first, fixed = (1, size[0]) if system else (0, 0)
    out, at = [], first
    while at < len(rows) or not out:
        begin = at
        for k in range(min(history_turns, at - first), 0, -1):
            shown = sum(size[at - k : at])
            if shown <= history_tokens and fixed + shown + size[at] <= budget:
                begin = at - k
                break
        end = min(at + 1, len(rows))
        while end < len(rows) and fixed + sum(size[begin : end + 1]) <= budget:
            end += 1
        own = [(1, bool(out))] if system else []
        out.append(own + [(i + 1, i < at) for i in range(begin, end)])
        assert fixed + sum(size[begin:end]) <= budget or (end - at <= 1 and begin == at)
        at = end
    return out


@pytest.mark.parametrize(("budget", "history_turns", "history_tokens"), [(1024, 2, 256), (60, 2, 40), (60, 3, 200), (40, 0, 0), (1, 2, 40)])
def test_chat_windows_brute_force(spark, sf_dir, budget, history_turns, history_tokens):
    """No window is over the budget unless its one own turn and the system turn are; history and masks are as planned."""
    r = random.Random(9)
    rows = [(i, t, "system" if t == 0 and i % 2 else "user" if t % 2 else "assistant", "w " * r.choice([0, 1, 5, 20, 33, 60])) for i in range(60) for t in range(r.randint(1, 9))]
    rows += [(100, 0, "user", "w " * 236), (100, 1, "assistant", "w " * 896), (101, 0, "system", "only")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.union(spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id + 1000", "turn", "role", "text"))
    conversations = collections.defaultdict(list)
    for x in turns.collect():
        conversations[x.conv_id].append((x.turn, x.role or "", x.text or ""))
    for x in chat.windows(turns, budget, history_turns, history_tokens).collect():
        own = sorted(conversations.pop(x.conv_id))
        assert [[(t.at, t.repeated) for t in w.turns] for w in x.windows] == plain_windows(own, budget, history_turns, history_tokens)
        for w in x.windows:
            assert [(t.start, t.end) for t in w.turns if own[t.at - 1][1] == "assistant" and not t.repeated] == [tuple(z) for z in w.loss]
    assert not conversations


def test_sharding(spark, odd):
    def table(shards, slots):
        number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
        prefer = {s: [(number(f"offset:{s}") % slots + j * (number(f"skip:{s}") % (slots - 1) + 1)) % slots for j in range(slots)] for s in shards}
        owner = {}
        while len(owner) < slots:
            for s in shards:
                if len(owner) < slots:
                    owner[next(x for x in prefer[s] if x not in owner)] = s
        return [owner[i] for i in range(slots)]

    assert sharding.lookup_table(["a", "b", "c"], 101) == table(["a", "b", "c"], 101)
    counts = collections.Counter(sharding.lookup_table({"a": 2, "b": 1}, 1009))
    assert 1.9 < counts["a"] / counts["b"] < 2.1
    names = sharding.lookup_table(sharding.SHARDS)
    for r in sharding.document_shards(odd).collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % sharding.TABLE_SLOTS
        assert (r.slot, r.shard) == (slot, names[slot])
    assert sharding.document_shards(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 100)


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0
            ok = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}
            if ok[kind]:
                out.append((m.start(), n, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_pii(spark, docs):
    r = random.Random(3)
    made = ["".join(r.choice("ab@.@..+1  2345-()9é😀") for _ in range(r.randint(0, 80))) for _ in range(400)]
    made += ["x a@b.c_d@e.f 1.2.3.4.5.6.7.8 256.1.1.1 +1 (555) 010-9999- 4111 1111 1111 1111", "4111-1111-1111-1111 0004.3.2.1", None]
    df = spark.createDataFrame(list(enumerate(made, 10**6)), "doc_id bigint, text string").union(docs.select("doc_id", "text"))
    got = {r.doc_id: r for r in pii.span_digest(df).collect()}
    for doc, text in texts(df):
        want = base_spans(text or "")
        assert got[doc].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in got[doc].spans.split(",") if s and not s.startswith("term")] == [s for s in want.split(",") if s]


def test_pii_terms(spark):
    """A word seen only beside one address is marked; words seen everywhere are not."""
    rows = [(i, "plain words the and of here") for i in range(60)] + [(100 + i, "the zanzibarian and joe@x.org of") for i in range(3)]
    found = {r.doc_id: r.terms for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [[(t.start, t.end) for t in found[100 + i]] for i in range(3)] == [[(4, 15)]] * 3
    assert not any(found[i] for i in range(60))


def plain_terms(rows):
    """Per row the places of disclosing words, from counts of whole documents."""
    words, values, masked = [], [], []
    for text in rows:
        spans = [s.split(":") for s in base_spans(text).split(",") if s]
        blank = list(text)
        for _, a, b in spans:
            blank[int(a) : int(b)] = " " * (int(b) - int(a))
        masked.append("".join(blank))
        values.append({(k, text[int(a) : int(b)]) for k, a, b in spans})
        words.append({w.lower() for w in regex.findall(r"[\p{L}\p{N}]+", text)})
    n_term = collections.Counter(w for ws in words for w in ws)
    n_value = collections.Counter(v for vs in values for v in vs)
    inside = [{w.lower() for w in regex.findall(r"[\p{L}\p{N}]+", t)} for t in masked]
    n_both = collections.Counter((v, w) for vs, ws in zip(values, inside, strict=True) for v in vs for w in ws)
    n, out = len(rows), []
    share = {(v, w): np.log2(c * n / (n_value[v] * n_term[w])) / np.log2(n / n_value[v]) for (v, w), c in n_both.items() if n_value[v] < n}
    for text, vs in zip(masked, values, strict=True):
        spans = []
        for m in regex.finditer(r"[\p{L}\p{N}]+", text):
            best = max((share.get((v, m[0].lower()), 0) for v in vs), default=0)
            if best >= 0.75:
                spans.append((m.start(), m.end(), bool(best >= 0.9)))
        out.append(spans)
    return out


def test_pii_terms_brute_force(spark, docs):
    """Terms come from whole documents: far from the value, in every place, for values of one document and of many."""
    r = random.Random(5)
    plain = [f"word{i}" for i in range(40)]
    rows = [" ".join(r.choice(plain) for _ in range(r.randint(1, 60))) for _ in range(120)]
    far = " ".join(plain[:20])
    rows += [f"Zanzibar\u00e9 {far} joe@x.org {far} zanzibar\u00c9 10.0.0.{i}" for i in range(4)] + ["zanzibar\u00e9 alone"]
    rows += ["once seen@one.example hapax \U0001f600 hapax"] + ["same +1 555 010 9999 rare same"] * 3 + [f"often a@b.c {far} joint{i % 2}" for i in range(45)]
    rows += [t or "" for _, t in texts(docs)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {x.doc_id: [tuple(t) for t in x.terms] for x in pii.find(df).collect()}
    want = plain_terms(rows)
    assert got == dict(enumerate(want)) and sum(map(len, want)) > 20
    assert [len([1 for a, b, _ in w if rows[120 + i][a:b].lower() == "zanzibar\u00e9"]) for i, w in enumerate(want[120:125])] == [2, 2, 2, 2, 0]
    clean = {x.doc_id: x.text for x in pii.sanitise(df).collect()}
    assert all("anzibar" not in clean[i] and "joe" not in clean[i] for i in range(120, 124)) and clean[0] == rows[0]


def test_pii_odd(odd):
    assert pii.span_digest(odd).count() == pii.sanitise(odd).count() == 8
    assert pii.span_digest(odd.limit(0)).count() == 0


def test_packing(spark, docs, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    strange = spark.createDataFrame([(-1, "a  b\n  c <|endoftext|> d "), (-2, None)], "doc_id bigint, text string")
    df = docs.select("doc_id", "text").union(strange)
    pieces = collections.defaultdict(list)
    for r in packing.packed_pieces(df).collect():
        pieces[r.doc_id].append(r)
    for doc, text in texts(df):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            assert r.start == at and r.offset == 0 and r.doc_tokens == len(ids) and r.length & (r.length - 1) == 0 and r.length <= 1024
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    every = [r.sequence_id for rows in pieces.values() for r in rows]
    assert len(every) == len(set(every))
    assert packing.packed_pieces(odd.limit(0)).count() == 0 and packing.packed_pieces(odd).count() > 8


def components(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    up = {d: d for d in sets}

    def top(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    up[y] = x
    return {d: (len(sets[d]), top(d)) for d in sets}


def test_jaccard(spark, docs):
    r = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    base = [r.choice(words) for _ in range(120)]
    shared = [r.choice(words) for _ in range(60)]
    made = []
    for i in range(90):
        near = list(base)
        for _ in range(r.randint(0, 4)):
            near[r.randrange(len(near))] = r.choice(words)
        made += [(10**6 + i, " ".join(near)), (2 * 10**6 + i, " ".join(shared + [r.choice(words) for _ in range(r.randint(5, 60))]))]
    made += [(3 * 10**6, "A b"), (3 * 10**6 + 1, "a B "), (3 * 10**6 + 2, ""), (3 * 10**6 + 3, None)]
    df = spark.createDataFrame(made, "doc_id bigint, text string").union(docs.select("doc_id", "text"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == components(texts(df))


def test_jaccard_odd(odd):
    got = jaccard_join.near_duplicates(odd).collect()
    assert len(got) == 8 and all((r.component_id is None) == (r.doc_id is None) for r in got)
    assert jaccard_join.near_duplicates(odd.limit(0)).count() == 0
    kept = jaccard_join.without_near_copies(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "2", "3", "4", "5", "None"]


def test_jaccard_dropped_once(spark, odd):
    """Copies are looked up in a stored table: the plan of what is kept does not hold their search, let alone twice."""
    plan = jaccard_join.without_near_copies(odd)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == plan.count("Join LeftAnti") == 2


def test_toxicity(spark):
    r = random.Random(5)
    words = [f"{a}{b}" for a in ("ba", "to", "ri", "sen") for b in ("na", "le", "mo", "tu")]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        body = [r.choice(words) for _ in range(60)] + (["vileword", "Grimword!"] * 2 if toxic else [])
        r.shuffle(body)
        rows.append((i, " ".join(body)))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(docs, known).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(held) == sorted(i for i, r in got.items() if r.held_out)
    assert sum(got[i].predicted == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    # Held-out labels and all other columns have no influence.
    other = spark.createDataFrame([(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels], "doc_id bigint, toxic int")
    again = {r.doc_id: r.score for r in toxicity.scores(docs, other).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)


@pytest.mark.parametrize(("toxic_phrase", "ordinary_phrase"), [("dark night", "night dark"), ("always vileword", "always")])
def test_toxicity_expressions(spark, toxic_phrase, ordinary_phrase):
    """Only the order of two words tells the class, or a word that always stands behind the same one."""
    r = random.Random(6)
    words = [f"{a}{b}" for a in ("ba", "to", "ri", "sen") for b in ("na", "le", "mo", "tu")]
    rows = []
    for i in range(1000):
        body = [r.choice(words) for _ in range(40)] + [toxic_phrase if i % 5 == 0 else ordinary_phrase] * 2
        r.shuffle(body)
        rows.append((i, " and ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(1000)], "doc_id bigint, toxic int")
    held = [r for r in toxicity.scores(docs, known).collect() if r.held_out]
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)


def test_toxicity_rounds(spark, monkeypatch):
    """A model that is taken in several rounds gives the same scores."""
    r = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [(i, " ".join(r.choice(words) for _ in range(30)) + (" vile grim" if i % 4 == 0 else "")) for i in range(200)] + [(200, None), (201, "")]
    rows += [rows[0]] * 3 + [(0, "alpha alpha"), (None, "beta vile"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int")
    def scored():
        return sorted((-1 if x.doc_id is None else x.doc_id, x.score) for x in toxicity.scores(docs, labels).collect())

    whole = scored()
    monkeypatch.setattr(toxicity, "ENTRIES_PER_ROUND", 20)
    parts = scored()
    assert len(whole) == len(parts) == len(rows)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-9 for a, b in zip(whole, parts, strict=True))


def plain_words(text):
    return re.findall(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def plain_models(labelled):
    """The log ratios of bigrams and of words, worked out with dictionaries."""
    d, heavy = toxicity.DISCOUNT, toxicity.SHARED_WEIGHT
    pair, word, before, contexts = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: [[0, 0], [0, 0]]), collections.Counter()
    for text, toxic in labelled:
        words = plain_words(text)
        for a, b in zip(["<start>", *words], words):
            pair[a, b][toxic] += 1
    for (a, b), n in pair.items():
        contexts[b] += 1
        for c in (0, 1):
            word[b][c] += n[c]
            before[a][0][c] += n[c]
            before[a][1][c] += n[c] > 0

    def kept(n):
        return max(n - d, 0)

    totals = [sum(n[c] for n in word.values()) for c in (0, 1)]
    both, left_both = sum(totals), sum(sum(n) - kept(sum(n)) for n in word.values())
    p = {}
    for w, n in word.items():
        shared = (kept(sum(n)) + left_both * contexts[w] / sum(contexts.values())) / both
        left = [sum(m[c] - kept(m[c]) for m in word.values()) for c in (0, 1)]
        p[w] = [(kept(n[c]) + (left[c] + heavy * totals[c]) * shared) / ((1 + heavy) * totals[c]) for c in (0, 1)]

    def after(a, b, c):
        total, types = before[a][0][c], before[a][1][c]
        own = (kept(pair[a, b][c]) + d * types * p[b][c]) / total if total else p[b][c]
        return (own + heavy * sum(pair[a, b]) / sum(before[a][0])) / (1 + heavy)

    return {k: np.log(after(*k, 1) / after(*k, 0)) for k in list(pair)}, {w: np.log(q[1] / q[0]) for w, q in p.items()}


def test_toxicity_models_brute_force(spark):
    r = random.Random(12)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(8)] + ["É", "straße"]
    texts = [" ".join(r.choice(vocabulary[: r.choice([5, 50])]) for _ in range(r.randint(0, 40))).replace(" wa", r.choice([" wa", ", WA", "1wa"])) for _ in range(120)]
    labelled = [(t, int(r.random() < 0.3)) for t in texts[:70]]
    model = toxicity.train(spark.createDataFrame(labelled, "text string, toxic int").repartition(5))
    got = {x.doc_id: x for x in toxicity.ratios(spark.createDataFrame([*enumerate(texts), (120, None)], "doc_id bigint, text string"), model).collect()}
    pairs, words = plain_models(labelled)
    for i, text in enumerate([*texts, None]):
        found = plain_words(text)
        each = [pairs.get((a, b), words.get(b, 0.0)) for a, b in zip(["<start>", *found], found)]
        assert got[i].words == len(found)
        assert abs(got[i].ratio - (sum(each) / len(each) if each else 0)) < 1e-6
        assert abs(got[i].strongest - max([0, *each])) < 1e-6


def test_toxicity_unseen_forms(spark):
    """Telling words that have another ending in each text are known by how they begin."""
    r = random.Random(9)
    syllables = ["na", "le", "mo", "tu", "é", "ßi"]
    words = [f"{a}{b}{c}" for a in ("ba", "to", "rü", "sen") for b in syllables for c in syllables]
    rows = []
    for i in range(1500):
        body = [r.choice(words) for _ in range(40)] + [("Grím" if i % 6 == 0 else "gräm") + "".join(r.choice(syllables) for _ in range(7))]
        r.shuffle(body)
        rows.append((i, " ".join(body)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(1500)], "doc_id bigint, toxic int")
    held = [x for x in toxicity.scores(docs, labels).collect() if x.held_out]
    for toxic in (True, False):
        own = [x for x in held if (x.doc_id % 6 == 0) == toxic]
        assert sum(x.predicted == toxic for x in own) >= 0.97 * len(own)
    left = {x.doc_id for x in toxicity.without_toxic(docs, labels).collect()}
    assert sum(x.doc_id in left for x in held if x.doc_id % 6 == 0) <= 0.03 * len(held)


def test_toxicity_beginnings_brute_force(spark):
    r = random.Random(13)
    vocabulary = [a + b for a in ("ab", "é", "straß", "xylo", "日本語話") for b in ("", "q", "rest", "ürze", "す")]
    texts = [" ".join(r.choice(vocabulary[: r.choice([4, 25])]) for _ in range(r.randint(0, 12))) for _ in range(90)]
    labelled = [(t, int(r.random() < 0.4)) for t in texts[:60]]
    model = toxicity.train(spark.createDataFrame(labelled, "text string, toxic int").repartition(5))
    got = {x.doc_id: x.beginning for x in toxicity.ratios(spark.createDataFrame([*enumerate(texts), (90, None)], "doc_id bigint, text string"), model).collect()}
    total, many = collections.Counter(t for _, t in labelled), [collections.Counter(), collections.Counter()]
    for text, toxic in labelled:
        many[toxic].update({w[: toxicity.BEGINNING] for w in plain_words(text)})
    smoothed = toxicity.SMOOTHED_BY / len(labelled)
    for i, text in enumerate([*texts, None]):
        own = {w[: toxicity.BEGINNING] for w in plain_words(text)} & {*many[0], *many[1]}
        want = max([0, *(np.log((many[1][w] / total[1] + smoothed) / (many[0][w] / total[0] + smoothed)) for w in own)])
        assert abs(got[i] - want) < 1e-6


def test_toxicity_odd(spark, odd):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (99, 1)], "doc_id bigint, toxic int")
    got = toxicity.scores(odd, labels).collect()
    assert len(got) == 8 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.scores(odd, labels.limit(0)).count() == 8 and toxicity.scores(odd.limit(0), labels).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_line_distance(spark):
    r = random.Random(6)
    pairs = []
    for _ in range(300):
        a = [r.choice("abcé😀") for _ in range(r.randint(0, 30))]
        b = list(a)
        for _ in range(r.randint(0, 4)):
            k = r.randint(0, len(b))
            b[k : k + r.randint(0, 1)] = r.choice(["", "x", "a"])
        pairs.append(("".join(a), "".join(b)))
    got = spark.createDataFrame(pairs, "a string, b string").selectExpr("a", "b", f"{line_dedup.distance('a', 'b')} AS d").collect()
    assert all(r.d == min(3, edit_distance(r.a, r.b)) for r in got)


def test_line_dedup(spark):
    base = "The quick brown fox jumps over the lazy dog again and again"
    rows = [(i, f"{base[:i]}Z{base[i + i % 2:]}\nshort {i % 3}\n\n{(base * 6)[: 300 - i % 4]}{'!' * (i % 3)}\nown line of number {i * i * 7919}") for i in range(40)]
    allowed = lambda n: 0 if n < 16 else 1 if n < 256 else 2
    first = {}
    for doc, text in rows:
        for at, line in enumerate(text.split("\n")):
            if line.strip(" "):
                first.setdefault(line, (doc, at))
    up = {line: line for line in first}

    def top(line):
        while up[line] != line:
            line = up[line]
        return line

    for a in first:
        for b in first:
            if len(a) <= len(b) <= len(a) + 2 and a != b and allowed(len(a)) and edit_distance(a, b) <= allowed(len(a)):
                up[top(a)] = top(b)
    best = {}
    for line, at in first.items():
        best[top(line)] = min(best.get(top(line), at), at)
    kept = set(best.values())
    want = {d: "\n".join(x for at, x in enumerate(t.split("\n")) if not x.strip(" ") or (d, at) in kept) for d, t in rows}
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.text for r in line_dedup.line_digest(df).collect()} == want


@pytest.mark.parametrize("crowded", [4, 40])
def test_line_pairs_of_crowded_keys(spark, monkeypatch, crowded):
    """Numbered lines of one and two edits, with numbers of any width anywhere, also two of them; lines of another
    pattern share their keys. Every pair is found, and no other."""
    monkeypatch.setattr(line_dedup, "CROWDED", crowded)
    r, long = random.Random(4), "some words of a longer line, again " * 8
    every = {f"line {i} of the text" for i in range(0, 1300, 5)} | {f"entry {i % 17} of {i} here" for i in range(150)}
    every |= {f"{long[:r.choice((3, 100, 200))]}{i * 7}{long[:270]}" for i in range(90)}
    every |= {f"{long}{i}-{i * i} \N{GREEK SMALL LETTER ALPHA}{'x' * (i % 3)}" for i in range(90)} | {"line of the text", f"{long}-"}
    every = sorted(every)
    got = line_dedup.near_lines(spark.createDataFrame([(i, x) for i, x in enumerate(every)], "doc_id bigint, text string"))
    names = {h: x for x, h in spark.createDataFrame([(x,) for x in every], "x string").selectExpr("x", "xxhash64(x)").collect()}
    allowed = lambda n: 0 if n < 16 else 1 if n < 256 else 2
    want = set()
    for i, a in enumerate(every):
        for b in every[:i]:
            k = allowed(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= k and sum((collections.Counter(a) - collections.Counter(b)).values()) <= k and edit_distance(a, b) <= k:
                want.add(frozenset((a, b)))
    assert len(want) > 300
    assert {frozenset((names[e.a], names[e.b])) for e in got.collect()} == want


def test_many_numbered_lines(spark):
    """Twice as many numbered lines do not take four times as many pairs."""
    def work(n):
        docs = spark.range(n).selectExpr("id div 1000 AS doc_id", "id").groupBy("doc_id").agg(F.array_join(F.collect_list(F.format_string("line %d of text", "id")), "\n").alias("text"))
        begin = time.time()
        left = line_dedup.first_lines(docs).count()
        return left, time.time() - begin

    (_, before), (left, after) = work(4000), work(16000)
    assert left >= 1 and after < 8 * before + 20


def test_line_dedup_odd(odd):
    got = line_dedup.without_repeated_lines(odd)
    assert got.columns == odd.columns and got.count() == 8
    assert line_dedup.line_digest(odd.limit(0)).count() == 0


def align(words, item):
    best, row = 0, [0] * (len(words) + 1)
    for x in item:
        new = [0]
        for j, y in enumerate(words):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment():
    r = random.Random(7)
    for _ in range(200):
        a, b = ([r.randint(0, 4) for _ in range(r.randint(1, 25))] for _ in range(2))
        assert decontaminate.align(decontaminate.np.asarray(a), decontaminate.np.asarray(b))[0] == align(a, b)


def test_decontamination(spark, sf_dir, docs):
    r = random.Random(8)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    plain = lambda t: re.findall(r"[^\W_]+", t.lower())
    items = {i.item_id: plain(i.text) for i in bench.collect()}
    edited = []
    for item, words in items.items():
        copy = [w if r.random() > 0.12 else "changed" for w in words]
        edited.append((10**6 + item, "Before it. " + ", ".join(copy) + " and after."))
    df = docs.select("doc_id", "text").union(spark.createDataFrame(edited, "doc_id bigint, text string"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminations(df, bench).collect()}
    exact = {(d, i) for d, t in texts(docs) for i, words in items.items() if f" {' '.join(words)} " in f" {' '.join(plain(t))} "}
    assert exact <= got and {(10**6 + i, i) for i, w in items.items() if len(w) > 15} <= got
    for doc, item in got:
        if doc < 10**6:
            words = plain(dict(texts(docs))[doc])
            assert align(words, items[item]) >= min(len(items[item]), 26)


def plain_copies(words, item):
    """All copies in a whole text, best first, each by its own alignment: (points, begin, end)."""
    least, found, left = min(len(item), 26), [], [(0, len(words))]
    while left:
        first, last = left.pop()
        best = (0, 0, 0)
        for end in range(first + 1, last + 1):
            # The best alignment that ends here is the best of the text up to here, where it is better than before.
            points = align(words[first:end], item)
            if points > best[0]:
                best = points, 0, end
        if best[0] < least:
            continue
        begin = max(b for b in range(first, best[2]) if align(words[b : best[2]], item) == best[0])
        found.append((best[0], begin, best[2]))
        left += [(first, begin), (best[2], last)]
    return sorted(found, key=lambda x: x[1])


def test_decontamination_brute_force(spark):
    """Parts, second copies, copies of numbers and edited ones, over several items at once, as a plain alignment finds them."""
    r = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "uvwxyz"] + [str(k) for k in range(10, 60)]
    some = lambda n: [r.choice(vocabulary) for _ in range(n)]
    items = {1: some(59), 2: some(16), 3: [str(7919 * k) for k in range(10)], 4: some(30)}
    edited = lambda ws, share: [w if r.random() > share else "changed" for w in ws]
    rows = {1: some(9) + items[1][20:49] + some(9), 2: items[3], 3: items[2] + some(30) + items[2] + some(4) + items[4], 4: some(60)}
    rows |= {5: some(5) + edited(items[1], 0.1) + some(5) + edited(items[4], 0.15), 6: items[1][:12] + some(20), 7: items[4][4:20] + some(3) + items[4][4:18]}
    spark_rows = [(i, " ".join(ws)) for i, ws in rows.items()]
    bench = spark.createDataFrame([(i, ", ".join(ws).upper()) for i, ws in items.items()], "item_id bigint, text string")
    got = collections.defaultdict(list)
    for x in decontaminate.contaminations(spark.createDataFrame(spark_rows, "doc_id bigint, text string"), bench).collect():
        before = rows[x.doc_id]
        begin = len(" ".join(before)[: x.start].split())
        got[x.doc_id, x.item_id].append((round(x.score * 2 * len(items[x.item_id])), begin, begin + len(x.passage.split())))
    want = {(d, i): found for d, ws in rows.items() for i, item in items.items() if (found := plain_copies(ws, item))}
    assert {k: sorted(v, key=lambda x: x[1]) for k, v in got.items()} == want
    assert {(1, 1), (2, 3), (3, 2), (7, 4)} <= set(want) and len(want[3, 2]) == 2 and (6, 1) not in want


def test_decontamination_odd(spark, odd):
    bench = spark.createDataFrame([(1, None), (None, "a b c d e f"), (2, ""), (3, "a b c d e f"), (4, "here")], "item_id bigint, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.contaminations(odd, bench).collect()]
    assert sorted(got, key=str) == [(1, 3), (1, 3), (None, 4)]
    assert decontaminate.contaminations(odd, bench.limit(0)).count() == 0 == decontaminate.contaminations(odd.limit(0), bench).count()


@pytest.mark.parametrize(("exact", "edited"), [(100, 1), (1, 30)])
@pytest.mark.parametrize("n", [15, 59])
def test_decontamination_many_copies(spark, n, exact, edited):
    """Seeds that an item's many copies make common still lead to the edited ones."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(n)]
    copy = [w if i % 4 < 3 else "changed" for i, w in enumerate(words)]
    rows = [(i, f"Before it, {' '.join(words if i < exact else copy)} and after.") for i in range(exact + edited)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    got = {r.doc_id: r.score for r in decontaminate.contaminations(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect()}
    assert got == {i: 1.0 if i < exact else align(copy, words) / (2 * n) for i in range(exact + edited)}


def test_registered_queries(spark, sf_dir):
    import __spark_entry__ as entry

    names = [re.match(r"(op\d+)_|pipeline", n) for n in entry.queries()]
    assert sorted(m[1] or m[0] for m in names if m) == sorted(["pipeline", *[f"op{k}" for k in range(1, 14)]])
    assert entry.queries()["op4_sharding"](spark, sf_dir).count() == 200


def test_pipeline(spark, sf_dir, docs):
    """The stages' brute-force versions in sequence lead to the same documents."""
    import corpus_pipeline

    now, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf_dir)
        assert now.columns == columns, name
    left = {r.doc_id for r in now.collect()}
    packed = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == left
    toxic = {r.doc_id for r in toxicity.scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()}
    assert not left & toxic


def test_jaccard_families(spark, monkeypatch):
    """Similar pairs across the parts of a family, over blocks smaller than it, equal brute force."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    monkeypatch.setattr(jaccard_join, "BITMAP_BLOCK", 32)
    draw = np.random.default_rng(5)
    pool = np.sort(draw.integers(0, 1 << 63, 90, dtype=np.uint64))
    sets, members = {}, {}
    for number in range(160):
        if number % 4:
            base = sets[number - 1]
            tokens = np.union1d(base[draw.random(len(base)) > 0.1], pool[draw.random(len(pool)) < 0.05])
        else:
            tokens = pool[draw.random(len(pool)) < draw.choice([0.2, 0.5, 0.9])]
        sets[number] = tokens
        members[number] = (number, number % 2, number % 2 if number < 60 else number)
    frame = spark.createDataFrame(list(members.values()), "class bigint, family bigint, part bigint")
    rows = [(k, len(t), bytearray(jaccard_join._bitmap(t)), bytearray(t.tobytes())) for k, t in sets.items()]
    data = spark.createDataFrame(rows, "class bigint, n int, bitmap binary, tokens binary")
    found = jaccard_join._within_families(jaccard_join._with_main(frame), data.drop("tokens"), data.select("class", "tokens"))
    got = {(min(r), max(r)) for r in found.collect()}
    want = set()
    for i in sets:
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            similar = 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared)
            if similar and members[i][1] == members[j][1] and members[i][2] != members[j][2]:
                want.add((j, i))
    assert got == want and len(want) > 10
