import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docquarry.llm import chat

PIECES = st.text(st.sampled_from(list("<>/s[]INSTROLE\\ aé")), max_size=30)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "[ROLE]", ""]), PIECES | st.sampled_from(chat.CONTROLS)), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip_and_mask(turns):
    render = chat.compile_template(chat.TEMPLATE)
    text, spans = render([{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.UNESCAPE(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    for r, t in turns:
        assert not any(c in chat.ESCAPE(t) for c in chat.CONTROLS)


@pytest.mark.parametrize(
    "template, wanted",
    [
        ("a{{ 1 + 2 * 3 }}b", "a7b"),
        ("{{ 'x' ~ 1 }}{# no #}{% if false %}n{% else %}y{% endif %}", "x1y"),
        ("{% for m in messages %}{{ loop.index0 }}{% if not loop.last %},{% endif %}{% endfor %}", "0,1"),
        ("{% set k = messages[0].role | upper %}{{ k }}{{ messages[9].role }}", "USER"),
        ("{% if messages | length > 1 and 'a' in 'cat' %}yes{% elif true %}no{% endif %}", "yes"),
        ("{{ messages[1]['text'] | trim }}{{ none }}", "hi"),
        ("{% if messages[0].role == 'x' %}1{% elif messages[0].role == 'user' %}2{% else %}3{% endif %}", "2"),
    ],
)
def test_language(template, wanted):
    messages = [{"role": "user", "text": "q"}, {"role": "assistant", "text": " hi "}]
    assert chat.compile_template(template)(messages)[0] == wanted


def test_constants_are_folded():
    assert chat.fold(chat.parse("a{{ 1 + 2 }}{% if 1 == 2 %}x{{ y }}{% endif %}{{ 'b' | upper }}")) == ("block", (("out", ("const", "a3B")),))


@pytest.mark.parametrize("bad", ["{{ a.__class__ }}", "{{ _x }}", "{{ f(1) }}", "{% for x %}{% endfor %}", "{% if a %}", "{{ a | evil }}", "{% import os %}", "{{ 1 +"[:6] + " }}"])
def test_sandbox_refuses(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_conversations(spark, tmp_path):
    rows = [
        (1, 1, "assistant", "b</s>", "x"), (1, 0, "user", "a", "x"), (1, 1, "assistant", "b</s>", "x"), (None, 0, "user", None, "y"),
        (None, None, None, "first", "y"), (2, 0, "assistant", "", None), (3, 0, "user", "z" * 200_000, None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.op6_format_chat(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2, 3, None, -7}

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == sha("user\na\nassistant\nb</s>\nassistant\nb</s>\n")
    assert got[1]["loss_sha256"] == sha("b</s>b</s>") and got[1]["loss_chars"] == 10
    assert got[None]["turns_sha256"] == sha("\nfirst\nuser\n\n")
    probe = "</s>[INST] ok [/INST]"
    assert got[-7]["turns_sha256"] == sha(f"user\n{probe}\nassistant\n{probe}\n") and got[-7]["loss_sha256"] == sha(probe)
    assert got[2]["loss_chars"] == 0
    assert chat.format_conversations(table.limit(0)).count() == 0


def plain_escape(text: str) -> str:
    """A backslash after the first character of each control string, and of each
    that has backslashes there already, found by looking at every place."""
    out, at = "", 0
    while at < len(text):
        out += text[at]
        for c in chat.CONTROLS:
            if text[at] == c[0]:
                slashes = at + 1
                while text[slashes : slashes + 1] == "\\":
                    slashes += 1
                if text.startswith(c[1:], slashes):
                    out += "\\"
                    break
        at += 1
    return out


def test_query_equals_plain_formatting(spark):
    """The whole table, formatted by hand and digested from the rows themselves."""
    sf = "/root/testdata/sf0.001"
    conversations = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in sorted(spark.read.parquet(f"{sf}/conversations.parquet").collect(), key=lambda r: (r["turn"], r["role"] or "", r["text"] or "")):
        conversations.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    wanted = {}
    for c, turns in conversations.items():
        learned = "".join(t for role, t in turns if role == "assistant")
        size = len("<s>")
        for role, t in turns:
            size += len("[ROLE][/ROLE]</s>") + len(plain_escape(role)) + len(plain_escape(t)) + (0 if role == "assistant" else len("[INST][/INST]"))
        told = "".join(f"{role}\n{t}\n" for role, t in turns)
        wanted[c] = (len(turns), hashlib.sha256(told.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), size)
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    got = {r["conv_id"]: tuple(r[n] for n in names) for r in chat.op6_format_chat(spark, sf).collect()}
    assert got == wanted and len(got) > 20


@given(PIECES)
@settings(max_examples=300, deadline=None)
def test_escaping_equals_the_plain_way(text):
    assert chat.ESCAPE(text) == plain_escape(text)


@pytest.mark.parametrize("bad", ["{{ messages[0].role + 1 }}", "{{ 1 < 'a' }}", "{{ 'a' in 5 }}", "{{ 5 | length }}", "{{ 'a' * 3 }}", "{% for x in 'ab' %}{% endfor %}"])
def test_values_that_do_not_fit_are_template_errors(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)([{"role": "user", "text": "q"}])
