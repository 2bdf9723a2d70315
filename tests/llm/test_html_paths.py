"""Blocks, paths and weights of pages against a plain walk over the tree a page was
written from, and pages whose text must not get lost."""
import random
import time
import tracemalloc

import pytest

from staylens.llm import html_text as ht

PARAS = [f"Paragraph {k} goes on for a while, with commas, and stops. Then it goes on again, and ends." for k in range(8)]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)


def tree(rng, depth=0):
    """(tag, class, children): children are trees or words."""
    tag = rng.choice(["div", "section", "blockquote", "b", "span", "td"] if depth else ["div"])
    inner = [rng.choice(["alpha", "beta, gamma.", "delta  \n x"]) if depth == 5 or rng.random() < 0.5 else tree(rng, depth + 1)
             for _ in range(rng.randrange(4))]
    return tag, rng.choice(["", "", "one", "two"]), inner


def written(node):
    if isinstance(node, str):
        return f" {node} "
    tag, cls, inner = node
    return f"<{tag}{f' class={cls}' if cls else ''}>{''.join(map(written, inner))}</{tag}>"


def walked(root):
    """(path, text) of the blocks of a tree, block element by block element."""
    out, text, at = [], [], [""]

    def flush():
        got = " ".join(" ".join(text).split())
        text.clear()
        if got:
            out.append((at[0], got))

    def walk(node, path, block):
        if isinstance(node, str):
            text.append(node)
            at[0] = block
            return
        tag, cls, inner = node
        mine = f"{path}/{tag}{'.' + cls if cls else ''}"
        is_block = tag in ht.BLOCK
        if is_block:
            flush()
        for child in inner:
            walk(child, mine, mine if is_block else block)
        if is_block:
            flush()

    walk(root, "", "")
    flush()
    return out


def test_blocks_of_random_trees():
    rng = random.Random(8)
    seen = 0
    for _ in range(1500):
        root = tree(rng)
        if any(t in written(root) for t in ("<b><div", "<td")):  # cells close cells, crossed tags differ
            continue
        want = walked(root)
        paths = ht.Paths()
        got = ht.blocks(written(root), paths)
        assert [b.text for b in got] == [t for _, t in want]
        # paths are equal where the spelled-out paths are, and lie under each other alike
        for (p, _), b in zip(want, got):
            for (q, _), c in zip(want, got):
                assert (p == q) == (b.path == c.path)
                assert p.startswith(q + "/") == paths.under(b.path, c.path)
        seen += len(got)
    assert seen > 900


def test_far_ancestors():
    rng, paths, parent = random.Random(1), ht.Paths(), {0: None}
    for k in range(3000):
        p = rng.randrange(max(0, len(parent) - 3), len(parent))
        parent[paths.below(p, f"x{k}")] = p
    for _ in range(300):
        a, b = rng.randrange(len(parent)), rng.randrange(len(parent))
        up, above = parent[a], set()
        while up is not None:
            above.add(up)
            up = parent[up]
        assert paths.under(a, b) == (b in above)


@pytest.mark.parametrize("page, text", [
    ("<p>One, two.</p><img alt=dog's src=x><p>Three, four.</p><p>It's five, six.</p>", "One, two.\nThree, four.\nIt's five, six."),
    ("<p class=a data-t=don't>Hello, there.</p>", "Hello, there."),
    ("<p title='a > b'>x, y.</p>", "x, y."), ('<p title="it\'s > that">x, y.</p>', "x, y."),
    ("<p a=b\"c d=\"e>f\">x, y.</p>", "x, y."), ("<p a= >x, y.</p>", "x, y."), ("<p a'b\">x, y.</p>", "x, y."),
    ("<a href=/x/>link</a><p>x, y.</p>", "link\nx, y."), ("<p =a=b>x, y.</p>", "x, y.")])
def test_quotes_in_tags(page, text):
    assert ht.main_text(page) == text


@pytest.mark.parametrize("mark", ['class="related-work"', 'class="notice-board-history"', 'class="comment-on-policy"',
                                  'id="alert-system-design"', 'class="with-sidebar"', 'class="hiddenGems"'])
def test_names_alone_lose_no_section_of_an_article(mark):
    page = f"<body><article><h1>Title</h1>{BODY}<section {mark}><h2>More</h2>{BODY.replace('Paragraph', 'Section')}</section></article></body>"
    assert ht.main_text(page).split("\n") == ["Title", *PARAS, "More", *(p.replace("Paragraph", "Section") for p in PARAS)]


@pytest.mark.parametrize("mark", ["comments", "comment-list", "sidebar", "ad-box", "cookie-notice", "relatedPosts", "newsletter"])
def test_names_that_speak_of_nothing_else_weigh_little(mark):
    page = f'<body><article>{BODY}<div class="{mark}"><p>I agree, a lot. Yes, I do.</p><ul><li>Me, too</li></ul></div></article></body>'
    assert ht.main_text(page).split("\n") == PARAS
    # where all text stands under such a name the ratios still choose
    assert ht.main_text(f'<body><div class="{mark}">{BODY}</div></body>').split("\n") == PARAS


def test_weight_of_names():
    full, half = ht.NAMED_WEIGHT, ht.HALF_NAMED_WEIGHT
    assert [ht.name_weight(x) for x in ("sidebar", "ad-banner", "site_footer", "commentList", "story", "no-sidebar")] == [
        full, full, 1.0 if "footer" not in ht.NOISE_PARTS else full, full, 1.0, 1.0]
    assert ht.name_weight("related-work") == pytest.approx(half)
    assert half < ht.name_weight("comment-on-policy") < 1


@pytest.mark.parametrize("page", ["<div>" * 50_000 + "text", "<div><b>x" * 25_000, "<p>" * 50_000 + "text", "</div>" * 50_000 + "text",
                                  "<b>" * 50_000 + "text" + "</i>" * 50_000])
def test_deep_nesting_is_linear(page):
    ht.main_text("<p>warm</p>")
    begun = time.process_time()
    assert ht.main_text(page)
    assert time.process_time() - begun < 4  # under 1 s on an idle machine
    tracemalloc.start()
    ht.main_text(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
