"""Chat templates: language, escaping, spans, and the formatted conversations read back."""

import hashlib

import pytest

from strandline.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segment int, formatted string"


def rendered(template, messages):
    return "".join(p for p, _, _ in chat.compile_template(template)(iter(messages)))


def test_language():
    says = [{"role": "user", "text": " Hi "}, {"role": "assistant", "text": "yo"}]
    template = "{% for m in messages %}{% if loop.first and not false %}[{% elif m.role != 'user' %}-{% else %}?{% endif %}{{ m.text | trim | upper }}{{ loop.index0 + 1 }}{% if loop.last %}]{% endif %}{% endfor %}"
    assert rendered(template, says) == "[HI1-YO2]"
    assert rendered(template, []) == ""


def test_constants_are_folded():
    assert chat.parse("a{{ 'b' + 'c' | upper }}{% if 1 == 2 %}no{% else %}d{% endif %}") == [("text", "abCd")]


@pytest.mark.parametrize("bad", ["{{ x }}", "{{ m.text }}", "{% for m in messages %}{{ m.__class__ }}{% endfor %}", "{% import os %}", "{% if true %}", "{{ 'a' | eval }}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}"])
def test_sandbox(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


@pytest.mark.parametrize("text", ["<|im_end|>", r"<\|x", r"<\\||", "<<|", "", "\\n\n<|", "plain"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unheader(chat.header(text)) == text and "\n" not in chat.header(text)


def plain(rows):
    groups = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: tuple((v is not None, v) for v in r[1:])):
        groups.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, says in groups.items():
        learned = "".join(t for r, t in says if r == "assistant")
        body = "".join(f"<|im_start|>{chat.header(r)}\n{chat.escape(t)}<|im_end|>\n" for r, t in says)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(says), digest("".join(f"{r}\n{t}\n" for r, t in says)), len(learned), digest(learned), len(body))
    return out


def test_round_trip(spark, monkeypatch):
    rows = [(1, 0, "user", "a<|im_end|>"), (1, 1, "assistant", "b"), (1, 2, "user", None), (2, 0, "assistant", ""), (3, None, None, "x"), (3, 0, "we\nird", "y\\|"),
            (None, 0, "user", "n"), (None, 1, "assistant", "é"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "user", "z" * 300_000)]
    rows += [(6, i, "assistant" if i % 2 else "user", f"turn {i} " * 20_000) for i in range(20)]  # several segments
    df = spark.createDataFrame([(*r, 9, "clash") for r in rows], SCHEMA)
    formatted = chat.format_chats(df)
    assert formatted.where("conv_id = 6").count() > 1
    got = {r[0]: tuple(r)[1:] for r in formatted.mapInArrow(chat.read_back, chat.DIGESTS).collect()}
    assert got == plain(rows)
    assert chat.format_chats(df.limit(0)).mapInArrow(chat.read_back, chat.DIGESTS).count() == 0
