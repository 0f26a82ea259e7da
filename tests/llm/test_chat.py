"""Chat tree: round trip, layout and attention."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from goldenrec.llm.chat import END, LEARNED, TEXT, TURN, build_tree, escape, format_turn, parse_turn, read_conversations, unescape

SCHEMA = "conv_id long, turn long, role string, text string, node string"
TALKS = {
    1: [("user", "hi"), ("assistant", "hello"), ("user", "a"), ("assistant", "b")],
    2: [("user", "hi"), ("assistant", "hello"), ("user", "a"), ("assistant", "c")],
    3: [("user", "hi"), ("assistant", "other")],
    4: [("user", "hi")],
    5: [("user", "hi"), ("assistant", "hello"), ("user", "a"), ("assistant", "b")],
    6: [("system", ""), ("user", "[INST] <|turn|>\\</s>"), ("assistant", "\\(é𝄞<")],
    -7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")],
    None: [("user", "hi"), ("assistant", "nobody")],
    8: [("user", f"turn {i}") if i % 2 == 0 else ("assistant", "x" * i) for i in range(400)],
    9: [("user", "hi"), ("user", "hi")],
}


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_hides_marks(text):
    assert unescape(escape(text)) == text
    assert "<" not in escape(text) and "[" not in escape(text)
    assert parse_turn(format_turn(text, text)) == (text, text)


@pytest.fixture(scope="module")
def tree(spark):
    rows = [(c, k, role, text, "x") for c, talk in TALKS.items() for k, (role, text) in enumerate(talk)]
    rows += [(20, 0, None, None, "x"), (20, None, "assistant", "first", "x"), (9, 1, "user", "hi", "x")]
    return build_tree(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5))


def turns_of(conv):
    if conv == 20:
        return [("assistant", "first"), ("", "")]
    return TALKS[conv] + ([("user", "hi")] if conv == 9 else [])


def test_read_back(tree):
    found = {r.conv_id: r for r in read_conversations(tree).collect()}
    assert set(found) == set(TALKS) | {20}
    for conv, row in found.items():
        turns = turns_of(conv)
        said = "".join(t for r, t in turns if r == LEARNED)
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert row.formatted_chars == sum(len(format_turn(r, t)) for r, t in turns)


def test_layout_and_attention(tree):
    nodes = {r.node: r for r in tree.nodes.collect()}
    prefixes = {tuple(turns_of(c)[: k + 1]) for c in [*TALKS, 20] for k in range(len(turns_of(c)))}
    assert len(nodes) == len(prefixes) == tree.nodes.count()
    by_tree = {}
    for node in nodes.values():
        by_tree.setdefault(node.tree, []).append(node)
        size = len(node.formatted)
        chain, parent = [node], node.parent
        while parent:
            chain.append(nodes[parent])
            parent = nodes[parent].parent
        # positions follow the conversation, whatever lies between in the packed sequence
        assert node.position == sum(len(n.formatted) for n in chain[1:])
        seen = {i for n in chain for i in range(n.start, n.start + len(n.formatted))}
        assert {i for a in node.attend for i in range(a["first"], a["last"])} == seen
        assert sum(a["last"] - a["first"] for a in node.attend) == node.position + size
        if node.role == LEARNED:
            text = node.formatted[node.learned["first"] : node.learned["last"]]
            assert node.formatted == f"{TURN}{LEARNED}{TEXT}{text}{END}"
        else:
            assert node.learned is None
    for own in by_tree.values():
        own.sort(key=lambda n: n.start)
        place = 0
        open_path = []
        for node in own:
            assert node.start == place
            place += len(node.formatted)
            # depth first: the parent is on the path of the node before
            while open_path and open_path[-1] != node.parent:
                open_path.pop()
            assert (open_path[-1] if open_path else "") == node.parent
            open_path.append(node.node)


def test_empty(spark):
    tree = build_tree(spark.createDataFrame([], SCHEMA))
    assert tree.nodes.count() == 0 and read_conversations(tree).count() == 0
