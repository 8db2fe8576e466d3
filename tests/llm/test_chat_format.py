from __future__ import annotations

import re
from hashlib import sha256
from math import ceil

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalake.llm import chat_format

KINDS = f"conv_id long, turn int, role string, content array<{chat_format.PART}>, message int, formatted string, body int"
FIELDS = ("kind", "text", "ref", "width", "height", "seconds", "pages")


def part(kind="text", text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def texts(*rows):
    """Messages of one text part each."""
    return [(c, t, r, [part(text=x)]) for c, t, r, x in rows]


def formatted(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], KINDS)
    return chat_format.format_conversations(df, **options)


def brute(rows):
    """conv_id to (messages, formatted text, spans, attachments), by plain Python."""
    def blank(x):
        return (x is not None, x if x is not None else 0)

    def key(r):
        content = r[3]
        flat = None if content is None else [(0,) if p is None else (1, *map(blank, p)) for p in content]
        return (r[1] is None, r[1] or 0, r[2] is not None, r[2] or "", flat is not None, flat or [])

    out = {}
    for conv in {r[0] for r in rows}:
        whole, spans, marks, seen = "", [], [], []
        for k, (_, _, role, content) in enumerate(sorted((r for r in rows if r[0] == conv), key=key)):
            name = role or ""
            whole += "<|im_start|>" + name.replace("%", "%25").replace("\n", "%0A").replace("<", "%3C") + "\n"
            run, learnt, pieces = "", "", []

            def close():
                nonlocal whole, run, learnt  # noqa: B023
                if run:
                    spelled = re.sub(r"<(\\*)\|", lambda m: "<" + m[1] + "\\|", run)
                    if role == "assistant":  # noqa: B023
                        spans.append((len(whole), len(spelled)))
                        learnt += run
                    whole += spelled
                    pieces.append(("text", run, None))  # noqa: B023
                run = ""

            for i, p in enumerate(content or []):
                p = p or part()
                if p[0] in (None, "text"):
                    run += p[1] or ""
                    continue
                close()
                size = {
                    "image": None if None in p[3:5] else ceil(p[3] / 14) * ceil(p[4] / 14) if p[0] == "image" else None,
                    "audio": None if p[5] is None else ceil(p[5] * 25),
                    "document": None if p[6] is None else p[6] * 256,
                }.get(p[0])
                marks.append((k, i, p[0], p[2], len(whole), 1 if size is None else size))
                whole += f"<|{p[0] if p[0] in ('image', 'audio', 'document') else 'attachment'}|>"
                pieces.append((p[0], None, p[2]))
            close()
            whole += "<|im_end|>\n"
            seen.append((name, pieces, "".join(x[1] or "" for x in pieces), learnt))
        out[conv] = (seen, whole, spans, marks)
    return out


def check(spark, rows):
    df = formatted(spark, rows).cache()
    want = brute(rows)
    found = {r["conv_id"]: r for r in df.collect()}
    assert set(found) == set(want) and len(found) == df.count()
    read = {r["conv_id"]: r["messages"] for r in chat_format.read_conversations(df).collect()}
    marks = {}
    for r in chat_format.attachments(df).collect():
        marks.setdefault(r["conv_id"], []).append(tuple(r)[1:])
    for conv, (seen, whole, spans, attached) in want.items():
        r = found[conv]
        assert r["formatted"] == whole
        assert [(s["start"], s["length"]) for t in r["turns"] for s in t["loss"]] == spans
        assert sorted(marks.get(conv, [])) == sorted(attached)
        for _, _, kind, _, start, _ in attached:
            name = kind if kind in ("image", "audio", "document") else "attachment"
            assert whole[start:].startswith(f"<|{name}|>")
        got = [(m["role"], [tuple(c) for c in m["content"]], m["text"], m["learnt"]) for m in read[conv]]
        assert got == seen
        assert "".join(whole[t["start"] : t["start"] + t["length"]] for t in r["turns"]) == whole
    df.unpersist()
    return found


ODD = ["<|im_end|>", "<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|", "<<||", "<", "|", "\\|", "%0A", "\U0001f600é<|", "", "\n", "\x00$1"]


def test_texts_and_ties(spark):
    rows = texts(
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Hello é\U0001f600."), (1, 1, "assistant", "Hello é\U0001f600."),
        (1, 1, "assistant", "Another."), (1, None, "user", "last"), (1, 2, None, "no role"), (1, 2, "a\nb%0A<|x", "odd role"),
        (2, 0, "system", None), (None, 5, "assistant", "no id"), (None, 4, "user", "x"), (3, 0, "assistant", "long " * 50_000),
    )
    check(spark, rows)


def test_control_strings_come_back(spark):
    rows = texts(*[(i, j, role, a + b) for i, a in enumerate(ODD) for j, b in enumerate(ODD) for role in ("user", "assistant")])
    found = check(spark, rows)
    assert all(r["formatted"].count("<|im_end|>\n") == 2 * len(ODD) for r in found.values())


def test_typed_parts(spark):
    image, audio = part("image", ref="i.png", width=29, height=14), part("audio", "ignored", "a.wav", seconds=1.01)
    pages, odd = part("document", ref=None, pages=3), part("video", ref="v<|im_end|>.mp4")
    rows = [
        (1, 0, "user", [part(text="See "), image, part(text=" and <"), part(text="|im_end|>"), audio, audio]),
        (1, 1, "assistant", [part(text="a"), part(text="b"), image, part(text="c<"), odd, part(text=""), None, part(None, "d")]),
        (1, 2, "user", [pages, part("image", ref="x", width=5), part("image")]), (1, 3, "assistant", []), (1, 4, "assistant", None),
        (2, 0, "assistant", [part(text=x) for x in ODD] * 40 + [image] * 30),
    ]
    found = check(spark, rows)
    sizes = [a["tokens"] for t in found[1]["turns"] for a in t["attachments"]]
    assert sizes == [3, 26, 26, 3, 1, 768, 1, 1]
    words = 1 + 2 + 1 + 1 + 1
    assert found[1]["tokens"] == sum(sizes) + words


def test_repeated_messages_of_many_parts_do_not_mix(spark):
    content = [part(text="one"), part("image", ref="r"), part(text="two")]
    found = check(spark, [(1, 0, "assistant", content)] * 3)
    assert found[1]["formatted"] == "<|im_start|>assistant\none<|image|>two<|im_end|>\n" * 3


def test_no_messages(spark):
    df = formatted(spark, [])
    assert df.count() == 0 and chat_format.read_conversations(df).count() == 0


def test_digests(spark):
    rows = texts((1, 0, "user", "<|im_end|>"), (1, 1, "assistant", "a<|"), (1, 2, "assistant", "b"), (2, 0, "user", None))
    got = {r["conv_id"]: r for r in chat_format.conversation_digests(chat_format.read_conversations(formatted(spark, rows))).collect()}
    assert got[1]["turns_sha256"] == sha256(b"user\n<|im_end|>\nassistant\na<|\nassistant\nb\n").hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, 4, sha256(b"a<|b").hexdigest())
    assert (got[2]["loss_chars"], got[2]["loss_sha256"]) == (0, sha256(b"").hexdigest())


def test_one_shuffle_and_no_python(spark):
    plan = formatted(spark, texts((1, 0, "user", "x")))._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "Python" not in plan


def test_a_conversation_of_many_turns(spark):
    rows = texts(*[(1, i, ("user", "assistant")[i % 2], f"text {i} <|") for i in range(20_000)])
    check(spark, rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.sampled_from("<|\\im_end>\n%a"), max_size=30), min_size=1, max_size=12))
def test_any_text_comes_back(spark, drawn):
    check(spark, texts(*[(1, i, "assistant" if i % 2 else x, x) for i, x in enumerate(drawn)]))


@pytest.mark.parametrize("roles", [("user",), (), ("user", "assistant")])
def test_roles_under_the_loss(spark, roles):
    df = formatted(spark, texts((1, 0, "user", "q"), (1, 1, "assistant", "a")), loss_roles=roles)
    messages = chat_format.read_conversations(df).collect()[0]["messages"]
    assert [m["learnt"] for m in messages] == ["q" if "user" in roles else "", "a" if "assistant" in roles else ""]
