from __future__ import annotations

import hashlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docmeter.llm import chat, oracles
from docmeter.llm.template import Expression, Template, TemplateError, fold
from docmeter.llm.turns import numbered, turn_digest

PIECES = st.lists(st.sampled_from(["\\", "\\\\", "<turn>", "</turn>", "<says>", "<chat>", "</chat>", "<", "turn>", ">", "a", "\n", "é", "<tu<turn>rn>"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=4))
def test_any_text_comes_back(turns):
    template = chat.compiled(chat.TEMPLATE, tuple(sorted(chat.CONSTANTS.items())))
    turns = [("assistant" if k % 2 else role, text) for k, (role, text) in enumerate(turns)]
    whole, learned = "", ""
    for k, (role, text) in enumerate(turns):
        assert chat.unescape(chat.escape(text)) == text
        part, spans = template.turn({"role": role, "text": text}, k, k + 1 == len(turns))
        assert chat.read_turns(part) == [(role, text)]
        learned += "".join(chat.unescape(part[a:b]) for a, b in spans)
        whole += part
    assert chat.read_turns(whole) == turns
    assert learned == "".join(text for role, text in turns if role == "assistant")


def test_long_runs_of_backslashes_are_linear():
    text = "\\" * 2_000_000 + "x" + "\\" * 2_000_000
    assert chat.unescape(chat.escape(text)) == text


def render(source: str, messages: list[dict], **constants) -> str:
    t = Template(source, constants=constants)
    return "".join(t.turn(m, k, k + 1 == len(messages))[0] for k, m in enumerate(messages))


def test_language():
    m = [{"role": "user", "text": " hi ", "tags": ["a", "b"]}, {"role": "assistant", "text": "yes", "tags": []}]
    loop = "{% for m in messages %}%s{% endfor %}"
    say = lambda body, **c: render(loop.replace("%s", body), m, **c)
    assert say("{{ m.role | upper }}:{{ m['text'] | trim }};") == "USER:hi;ASSISTANT:yes;"
    assert say("{% if m.role == 'user' and not loop.last %}U{% elif loop.index == 2 %}A{% else %}?{% endif %}") == "UA"
    assert say("{% for t in m.tags %}{{ loop.index }}{{ t }}{% if not loop.last %},{% endif %}{% endfor %}|") == "1a,2b||"
    assert say("{% set x = m.text | trim | length %}{{ x + 1 }}{{ 'odd' if x % 2 else 'even' }} ") == "3even 4odd "
    assert say("{{ m.missing }}{{ m.role.upper }}{{ 'x' ~ 1 ~ none }}{# no #}") == "x1x1"
    assert say("  {%- if 'a' in m.tags or sep == '!' -%}  +  {%- endif %}{{ sep }}", sep="-") == "+--"
    assert render("a{{ n }}{% for m in messages %}.{% endfor %}z", m, n=1) == "a1..z"
    out = Template(loop.replace("%s", "{% generation %}a{% generation %}b{% endgeneration %}{% endgeneration %}c{% generation %}{{ m.none }}{% endgeneration %}")).turn(m[0], 0, False)
    assert out == ("abc", [(0, 2)])


def test_constants_are_folded():
    t = Template("{{ 'a' | upper }}{{ b }}{% if b == 'x' %}no{% else %}yes{% endif %}{% for m in messages %}{% if b %}{{ b ~ 1 }}{% endif %}{{ m.x }}{% endfor %}{{ 2 + 3 }}", constants={"b": "c"})
    assert t.tree == ([("text", "Acyes")], [("text", "c1"), ("out", ("member", ("name", "m"), ("lit", "x")))], [("text", "5")])
    assert fold(Expression("false and m.x").whole(), {}, {}) == ("lit", False)
    assert fold(Expression("m.x and (1 < 2)").whole(), {}, {}) == ("and", ("member", ("name", "m"), ("lit", "x")), ("lit", True))
    # a name set in the template is no constant any more
    assert render("{% for m in messages %}{% if m.y %}{% set b = 'd' %}{% endif %}{{ b }}{% endfor %}", [{"y": 1}], b="c") == "d"


@pytest.mark.parametrize(
    "source",
    [
        "no loop", "{% for m in messages %}", "{% for m in messages %}{{ m.x }}{% endif %}{% endfor %}", "{% for m in messages %}{{ os }}{% endfor %}", "{% for m in messages %}{{ m.x() }}{% endfor %}",
        "{% for m in messages %}{{ m.x | open }}{% endfor %}", "{% for m in messages %}{% include 'x' %}{% endfor %}", "{% for m in messages %}{{ m. }}{% endfor %}", "{% for m in messages %}{{ 1 1 }}{% endfor %}",
        "{% for m in messages %}{% if 1 %}{% else %}{% elif 2 %}{% endif %}{% endfor %}", "{% for m in messages %}{{ m.x }}{% endfor %}{{ m.x }}", "{% for m in messages %}{{ '%9d' % 1 }}{% endfor %}",
    ],
)
def test_bad_templates_are_errors(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_no_python_objects_are_reached():
    assert render("{% for m in messages %}{{ m.__class__ }}{{ m.x.__class__ }}{{ m.x['__doc__'] }}{{ m.x.real }}{% endfor %}", [{"x": 5}]) == ""


def test_turns_are_numbered_across_ranges(spark):
    rows = [(7, k, "user", "t") for k in range(3000)] + [(7, 5, "user", "t")] * 500 + [(None, 1, "a", None)] * 700 + [(None, None, None, "x")] + [(k, 0, "a", "b") for k in range(100, 150)] + [(8, None, "a", "z"), (8, 0, "a", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("digest", turn_digest())
    found = defaultdict(list)
    for r in numbered(df, ["turn"]).collect():
        found[r.conv_id].append((r.pos, r.turn, r.last))
    expected = defaultdict(list)
    for c, t, *_ in rows:
        expected[c].append(t)
    for c, turns in expected.items():
        turns = sorted(turns, key=lambda t: (t is not None, t or 0))
        assert sorted(found[c]) == [(k, t, k + 1 == len(turns)) for k, t in enumerate(turns)]


ROWS = [
    (1, 0, "user", "a <turn> \\"), (1, 1, "assistant", "\\</turn>\\\\"), (1, 2, None, None), (2, 1, "assistant", ""), (2, None, "assistant", "é<says>\\"), (3, 5, "x<says>\n", "<chat>"), (None, 1, "assistant", "n"), (None, 0, "user", None),
    (4, 1, "assistant", "same"), (4, 1, "assistant", "same"), (5, 0, "assistant", "word " * 200_000), *[(6, k, "user" if k % 2 else "assistant", f"t{k}\\") for k in range(400)],
]


def test_query_equals_sql_and_a_fold(spark, tmp_path):
    spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit("x")).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in chat.op12_chat_format(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    assert got == {r[0]: r[1:] for r in con.sql(f"select conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from ({oracles.CHAT})").fetchall()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for c in (1, 2, 3, 5, 6):
        turns = sorted((x for x in ROWS if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0))
        learned = "".join(x[3] or "" for x in turns if x[2] == "assistant")
        assert got[c][:4] == (len(turns), sha("".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in turns)), len(learned), sha(learned))
    assert got[-7][:3:2] == (2, len(chat.PLANTED[1]))


def test_empty_tables_and_other_templates(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(none).count() == 0
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], none.schema)
    out = chat.format_conversations(rows, "{{ bos }}{% for m in messages %}{% generation %}{{ m.text }}{% endgeneration %}{{ loop.index0 }}{% endfor %}.", {"bos": "#"}, batch_chars=1).orderBy("pos").collect()
    assert [(r.formatted, [tuple(s) for s in r.loss]) for r in out] == [("#q0", [(1, 2)]), ("a1.", [(0, 1)])]
    with pytest.raises(TemplateError):
        chat.format_conversations(rows, "{% for m in messages %}{{ x }}{% endfor %}")
