"""Page trees with implied end tags, and JSON in scripts."""

import json
import time
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from siltworks.sources.pages import Tree, loose_objects, objects_with, script_objects

TAGS = frozenset("a p h1 tr td li option div".split())
OPTIONAL = re.compile("</(?:p|li|tr|td|option|dd|dt|tbody)>")


def seen(page):
    return [(x["tag"], x["row"], x["classes"], x["id"], x["text"]) for x in Tree(page, TAGS).found]


word = st.text("abc &", min_size=1, max_size=5).map(lambda t: t.replace("&", "&amp;"))
inline = st.recursive(word, lambda x: st.lists(x, max_size=3).map(lambda c: "<b class='k'>" + "".join(c) + "</b>"), max_leaves=4)
para = st.lists(inline, max_size=3).map(lambda c: "<p>" + "".join(c) + "</p>")


def blocks(inner):
    several = st.lists(inner, max_size=3).map("".join)
    return st.one_of(
        several.map(lambda c: f"<div class='d'>{c}</div>"),
        st.lists(several, max_size=3).map(lambda c: "<ul>" + "".join(f"<li>{x}</li>" for x in c) + "</ul>"),
        st.lists(st.lists(several, max_size=3), max_size=3).map(lambda r: "<table><tbody>" + "".join("<tr>" + "".join(f"<td>{x}</td>" for x in c) + "</tr>" for c in r) + "</tbody></table>"),
        st.lists(word, max_size=3).map(lambda c: "<div><select>" + "".join(f"<option>{x}</option>" for x in c) + "</select></div>"),
        st.lists(inner, max_size=2).map(lambda c: "<dl>" + "".join(f"<dt>t</dt><dd>{x}</dd>" for x in c) + "</dl>"),
    )


page = st.lists(st.recursive(para, blocks, max_leaves=12), max_size=4).map("".join)


@settings(max_examples=400, deadline=None)
@given(page)
def test_pages_without_optional_end_tags_read_like_their_closed_forms(closed):
    assert seen(OPTIONAL.sub("", closed)) == seen(closed)


def test_depth_has_no_limit():
    deep = "<span>" * 5000 + "deep" + "</span>" * 5000
    assert seen(f"<a>head {deep} tail</a>") == [("a", -1, [], None, "head deep tail")]
    assert [x[4] for x in seen("<p>one<p>two<p>three")] == ["one", "two", "three"]
    assert [x[4] for x in seen("<div><p>x" + "<i>" * 200 + "y</div><p>z")] == ["x y".replace(" ", ""), "xy", "z"]


def test_an_end_tag_stays_inside_its_cell():
    got = seen("<div><table><tr><td>a</div>b<td>c</table>d</div>e")
    assert ("td", 0, [], None, "ab") in got and got[0][4] == "ab c d"


value = st.recursive(st.one_of(st.none(), st.booleans(), st.integers(-99, 99), st.floats(-9, 9), st.text('{}[]",:\\é a', max_size=6)), lambda v: st.one_of(st.lists(v, max_size=3), st.dictionaries(st.sampled_from(["k", "m", "x", "{"]), v, max_size=4)), max_leaves=12)
noise = st.sampled_from(["", "var a={b:1};", "f([1,", "]})", "if(a<b){", "}", "'it''s'", ";x=", "{k:1,", "/*{*/"])


def planted(v):
    """Objects with the members k and m, from the outer to the inner, in page order."""
    here = [v] if isinstance(v, dict) and {"k", "m"} <= v.keys() else []
    return here + [x for c in (v.values() if isinstance(v, dict) else v if isinstance(v, list) else ()) for x in planted(c)]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(noise, st.dictionaries(st.sampled_from(["k", "m", "x"]), value, min_size=1)), max_size=4), st.booleans())
def test_objects_are_found_whatever_stands_around(parts, spaced):
    script = "".join(n + ";" + json.dumps(v, separators=(", ", " : ") if spaced else (",", ":")) + ";" for n, v in parts)
    got = [json.loads(x) for x in objects_with(script, frozenset(["k", "m"]))]
    assert got == [x for _, v in parts for x in planted(v)]


def test_strings_that_hold_objects_are_read():
    inner = json.dumps({"list": [{"k": 'a "q"', "m": None}, {"m": 1, "sub": {"k": 2}}]})
    page = f"<p>{{</p><script>self.push([1,{json.dumps('1:' + inner)}])</script>"
    assert [json.loads(x) for x in script_objects(page, frozenset("km"))] == [{"k": 'a "q"', "m": None}]


def test_time_grows_with_the_page():
    def took(n):
        rng = random.Random(1)
        page = "".join('{"k":[' * 3 + str(rng.random()) + ",x" + "]}" * 3 + '{"k":1,"m":2}' for _ in range(n)) + '{"k":{' * n
        began = time.perf_counter()
        assert len(objects_with(page, frozenset("km"))) == n
        return time.perf_counter() - began

    took(500)
    assert took(16_000) < 30 * took(1_600)


def test_tags_that_say_nothing_are_one_step(monkeypatch):
    seen = []
    known = Tree.handle_starttag
    monkeypatch.setattr(Tree, "handle_starttag", lambda self, tag, attrs: (seen.append(tag), known(self, tag, attrs))[1])
    page = '<h1 id="a">' + "<span>" * 90 + "One <B>two</h1><p>" + "<i><span>" * 50 + "three"
    assert [(x["text"], x["start"], x["end"]) for x in Tree(page, frozenset(["h1", "p"])).found] == [("One two", 0, page.index("<p>")), ("three", page.index("<p>"), len(page))]
    assert seen == ["h1", "p"]
    # Where an element is ended somewhere, its start counts.
    assert [x["text"] for x in Tree("<span><p>in</span>out", frozenset(["p"])).found] == ["in"]


def test_pieces_that_nobody_wants_have_no_text():
    page = "<div>" * 50 + "<table><tr><td>x<div class=c>y</div></table>"
    found = Tree(page, frozenset(["div", "tr"]), lambda x: x["row"] >= 0).found
    assert [(x["tag"], x["text"]) for x in found] == [("tr", "x y"), ("div", "y")]


def test_strings_that_never_end_are_followed_once():
    card = '{"k":"one","m":"two"}'
    n = 1500
    script = ",".join([card] * n).replace('"', '\\"')
    begun = time.monotonic()
    assert objects_with(script, frozenset("km")) == [] == loose_objects("x" + script, frozenset("km"))
    assert len(script_objects(f"<script>[{script}]</script>", frozenset("km"))) == n
    assert time.monotonic() - begun < 5
