"""Template compiler and formatted conversations."""

import hashlib
import random
from itertools import groupby

import pytest

from speechprep.llm import chat, queries
from speechprep.llm.template import (
    FILTERS,
    Block,
    Const,
    Output,
    TemplateError,
    compile_template,
    fold,
    parse,
)


def render(source, **scope):
    return compile_template(source)(scope)


@pytest.mark.parametrize(
    "source,expected",
    [
        ("a{# no #}b", "ab"),
        ("{{ 'x' ~ 1 + 2 }}|{{ \"q\\n\" }}", None),
        ("{{ 1 + 2 ~ 'x' }}", "3x"),
        ("{% if a %}1{% elif b == 2 %}2{% else %}3{% endif %}", "2"),
        ("{% if not a and b in (b) %}y{% endif %}", None),
        ("{% for x in xs %}{{ loop.index }}{{ x.k }}{% if not loop.last %},{% endif %}{% endfor %}", "1u,2v"),
        ("x {%- if true -%} y {%- endif %} z", "xy z"),
        ("{% set q = xs[1]['k'] | upper %}{{ q }}{{ q | length }}", "V1"),
        ("{{ missing }}{{ xs[9] }}{{ none }}{{ true }}", "true"),
        ("{{ 'a' in 'cab' }}{{ 'a' not in 'cab' }}{{ 1 <= 2 or x.y.z }}", "truefalsetrue"),
        ("{{ '  p ' | trim }}{{ (b) }}", "p2"),
    ],
)
def test_language(source, expected):
    scope = {"b": 2, "xs": [{"k": "u"}, {"k": "v"}]}
    if expected is None:
        with pytest.raises(TemplateError):
            render(source, **scope)
    else:
        assert render(source, **scope)[0] == expected


@pytest.mark.parametrize(
    "source",
    ["{% if a %}", "{% call x %}", "{{ a() }}", "{{ a.b. }}", "{{ a | nofilter }}", "{{ }}",
     "{{ a[0 }}", "{{ 'a }}", "{% for 1 in x %}{% endfor %}", "{{ a b }}"],
)
def test_bad_templates(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_sandbox():
    for source in ("{{ a.__class__ }}", "{{ a['__class__'] }}", "{{ a | length | upper }}"):
        with pytest.raises(TemplateError):
            render(source, a=3) if "length" not in source else render("{{ a.x }}", a=3)
    assert render("{{ a.__class__ }}", a={})[0] == ""


def test_constants_are_folded():
    tree = fold(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}{{ x }}{% else %}c{% endif %}{{ '' }}d"), FILTERS)
    assert tree == Block((Output(Const("ab1cd")),))


def test_generation_spans():
    text, spans = render("{% for x in xs %}<{% generation %}{{ x }}{% endgeneration %}>{% endfor %}", xs=["é", "", "bc"])
    assert text == "<é><><bc>" and [text[a:b] for a, b in spans] == ["é", "", "bc"]


BITS = [*chat.CONTROL, "<", "\\", "[", "|", ">", "im_end|>", "s>", "\n", "x", "é", "😀", "/INST]", "<\\s>", "<\\\\s>"]


def test_escapes_are_reversible_and_leave_no_control_string():
    rng = random.Random(3)
    for _ in range(30_000):
        text = "".join(rng.choices(BITS, k=rng.randint(0, 6)))
        for there, back in ((chat.guard, chat.unguard), (chat.field, chat.unfield)):
            done = there(text)
            assert back(done) == text
            assert not any(c in done for c in chat.CONTROL)
        assert "\n" not in chat.field(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_and_edge_cases(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for conv in [*range(60), None]:
        for turn in [*range(rng.choice([1, 2, 9, 70])), None, 1]:
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a\n\\b", "<s>"])
            text = rng.choice([None, "", "".join(rng.choices(BITS, k=5)), "plain text"])
            rows.append((conv, turn, role, text, "x"))
    rows += rows[:5]
    rows.append((1000, 0, "assistant", "w<s>é" * 100_000, "x"))
    rng.shuffle(rows)
    schema = "conv_id long, turn long, role string, text string, formatted string"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op5_chat(spark, str(tmp_path)).collect()}
    said = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", said, ""), (-7, 1, "assistant", said, "")]

    def order(row):
        return [(v is not None, v if v is not None else 0) for v in row[:2]] + [
            (v is not None, v or "") for v in row[2:4]
        ]

    rows.sort(key=order)
    count = 0
    for conv, turns in groupby(rows, key=lambda r: r[0]):
        turns = [(r or "", t or "") for _, _, r, t, _ in turns]
        learnt = "".join(t for r, t in turns if r == "assistant")
        row, count = got[conv], count + 1
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(learnt), sha(learnt))
        assert row.formatted_chars >= sum(len(t) for _, t in turns)
    assert count == len(got) == 63
    none = spark.createDataFrame([], schema)
    assert chat.read_back(chat.format_conversations(none)).count() == 0
