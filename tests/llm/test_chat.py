import hashlib
import random

import pytest

from munimetrics.llm import chat
from munimetrics.llm.template import CUT, Template, TemplateError, parse

CASES = [
    ("a{{ 1 + 2 * 3 }}b", {}, "a7b"),
    ("{{ 'x' ~ 3 ~ none ~ true }}", {}, "x3true"),
    ("{% if a and not b %}yes{% elif c %}maybe{% else %}no{% endif %}", {"a": 1, "b": 0}, "yes"),
    ("{% if a %}yes{% elif c %}maybe{% else %}no{% endif %}", {"c": "x"}, "maybe"),
    ("{% if a is defined %}{{ a }}{% else %}-{% endif %}{{ b is not none }}", {"b": None}, "-false"),
    ("{% for x in xs %}{{ loop.index }}:{{ x.k }}{{ '' if loop.last else ', ' }}{% endfor %}", {"xs": [{"k": "p"}, {"k": "q"}]}, "1:p, 2:q"),
    ("{% set n = 4 %}{{ n // 3 }}{{ n % 3 }}{{ -n }}", {}, "11-4"),
    ("{{ xs[1] }}{{ xs[-1] }}{{ xs[9] }}{{ m['k'] | upper }}", {"xs": [5, 6], "m": {"k": "é"}}, "66É"),
    ("  {%- if 1 == 1 -%}  t  {%- endif -%}  u", {}, "tu"),
    ("{# gone #}{{ 'a' in 'cab' }}{{ 3 not in xs }}", {"xs": [1]}, "truetrue"),
    ("{{ ' a ' | trim | length }}{{ q | default('z') }}{{ xs | tojson }}", {"xs": ["é", 1]}, '1z["é", 1]'),
    ("{{ 'it\\'s' }}{{ \"%}\\n\" }}", {}, "it's%}\n"),
    ("{{ a if b else c }}", {"c": 9}, "9"),
    ("{{ 1 < 2 and 'a' >= 'b' or 'k' }}", {}, "k"),
    ("{% for x in [] %}{% endfor %}", None, None),
    ("{{ ''.__class__ }}{{ xs.append }}{{ m.items }}", {"xs": [1], "m": {}}, ""),
]


@pytest.mark.parametrize("source,env,want", CASES)
def test_language(source, env, want):
    if env is None:
        with pytest.raises(TemplateError):
            Template(source)
        return
    assert Template(source).render(env)[0] == want
    # The same with all names given as constants: all is folded but loops.
    folded = Template(source, env)
    assert folded.render({})[0] == want


@pytest.mark.parametrize(
    "source",
    ["{% if a %}", "{% endfor %}", "{{ }}", "{{ a b }}", "{{ (a }}", "{{ a | nofilter }}", "{% for in x %}{% endfor %}", "{{ a ! b }}",
     "{{ f(1) }}", "{% include 'x' %}", "{{ " + "(" * 200 + "1" + ")" * 200 + " }}", "{% generation x %}{% endgeneration %}"],
)
def test_malformed(source):
    with pytest.raises(TemplateError):
        Template(source).render({})


def test_no_value_fails_only_where_reached():
    template = Template("{% if a %}{{ 1 // 0 }}{% endif %}ok")
    assert template.render({})[0] == "ok"
    with pytest.raises(TemplateError):
        template.render({"a": True})
    with pytest.raises(TemplateError):
        Template("{{ 'x' * 9 }}").render({})


def test_constants_fold_to_one_text():
    tree = Template("{{ b }}x{{ 1 + 1 }}{% if b == '<s>' %}y{% else %}{{ z }}{% endif %}", {"b": "<s>"}).tree
    assert [(n.kind, n.value) for n in tree] == [("text", "<s>x2y")]
    assert len(parse("{{ b }}x")) == 2
    # A name that is set, or a loop's own, is no constant below.
    assert Template("{% for b in xs %}{{ b }}{{ loop.index }}{% endfor %}{{ b }}", {"b": "c", "loop": 1}).render({"xs": [7]})[0] == "71c"
    assert Template("{{ b }}{% set b = 2 %}{{ b }}", {"b": 1}).render({})[0] == "12"


def test_loops_read_as_they_write():
    read = []

    def messages():
        for n in range(5):
            read.append(n)
            yield {"text": str(n)}

    flow = Template("{% for m in ms %}{{ m.text }}{% endfor %}").pieces({"ms": messages()})
    assert next(flow) == "0" and next(flow) is CUT and len(read) == 2


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(1)
    signs = ["<", ">", "[", "]", "/", "\\", "s>", "/s>", "INST]", "/INST]", "<s>", "</s>", "[INST]", "[/INST]", " ok ", "é", "\n"]
    for _ in range(20_000):
        text = "".join(rng.choices(signs, k=rng.randrange(9)))
        plain = chat.DEFAULT.plain(text)
        assert chat.DEFAULT.restored(plain) == text
        assert not any(c in plain for c in (chat.BEGIN, chat.OPEN, chat.CLOSE, chat.STOP))
        role = "".join(rng.choices(signs, k=2))
        parts = list(chat.DEFAULT.parts(iter([{"role": role, "text": text}, {"role": "assistant", "text": text}])))
        assert list(chat.DEFAULT.turns(parts[0][0])) == [(role, text), ("assistant", text)]


def brute_force(rows):
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append(((t is not None, t or 0), (r is not None, r or ""), (x is not None, x or "")))
    result = {}
    for c, turns in out.items():
        turns = [(r[1], x[1]) for _, r, x in sorted(turns)]
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        result[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return result


def test_edge_cases(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 5, "user", "x"),
            (None, 4, None, "</s>[INST]\\[\\INST]"), (2, None, "assistant", ""), (2, 0, "[INST]\n", "🙂é"), (3, 0, "", ""),
            (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-7, 0, "user", "</s>[INST] ok [/INST]")]
    rows += [(9, n, "assistant" if n % 2 else "user", "[INST] word " * 40_000) for n in range(12)]  # several parts
    frame = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, id string, part int")
    parts = chat.format_conversations(frame)
    want = brute_force(rows)
    for found in (chat.read_back(parts), chat.read_back(parts.repartition(3), ordered=False)):
        assert {r.id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found.collect()} == want
    numbers = sorted(r.part for r in parts.filter("id = 9").collect())
    assert len(numbers) > 3 and numbers == list(range(len(numbers)))
    for r in parts.filter("id = 1").collect():
        assert [r.formatted[s.start : s.end] for s in r.learnt] == ["", "b", "b"]
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0


def test_other_template(spark):
    own = chat.ChatFormat(
        "{% if messages %}{% for m in messages %}{{ open }}{{ m.role | plain }}{{ close }}{% if m.role != 'user' %}{% generation %}"
        "{{ m.text | plain }}{% endgeneration %}{% else %}{{ m.text | plain }}{% endif %}{{ stop }}{{ '\n' }}{% endfor %}{% endif %}",
        begin="<|a|>", open_="<|turn|>", close="<|say|>", stop="<|end|>",
    )
    frame = spark.createDataFrame([(1, 0, "user", "<|end|>"), (1, 1, "tool", "<\\|end|>x")], "conv_id int, turn int, role string, text string")
    (row,) = chat.read_back(chat.format_conversations(frame, own), own).collect()
    assert row.n_turns == 2 and row.loss_chars == 9 and row.loss_sha256 == hashlib.sha256(b"<\\|end|>x").hexdigest()
