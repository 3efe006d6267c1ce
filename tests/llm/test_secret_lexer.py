"""The lexer of the secret scan: each syntax, and generated programs against brute force."""

import random
import time

import pytest

from tidepool.llm import secrets

A, B = "aB3dXk9mPq2v", "7hJ9zQw4TtR1"


def found(text):
    return [text[a:b] for a, b, _ in secrets.assigned_spans(text)]


@pytest.mark.parametrize("text", [
    f'db_pwd = """{A}"""', f"db_pwd = '''\n{A}\n'''", f'db_pwd: str = "{A}"', f"db_pwd = rb'{A}'", f"export DB_PWD={A}",
    f"[db]\npwd={A}\nport=1", f"pwd: {A}\n", f'{{"db": {{"pwd": "{A}", "port": 1}}}}', f"<db><pwd>{A}</pwd></db>",
    f"<pwd lang='x'>\n  {A}\n</pwd>", f'<db pwd="{A}"/>', f"connect(host=h, pwd='{A}')", f'# db_pwd = "{A}"', f'/* {{ */ db_pwd = "{A}"',
    f'x = "a \\" { "{" } b"\ndb_pwd = "{A}"', f"run: |\n  export PWD={A}\nport: 1", f'db_password = x1\nx1 = "{A}"',
    f'a = b\nb = a\npwd = a\nb = "{A}"', f'K = "{A}"\ndef g():\n    db_pwd = K\n', f'if (a) {{ x = "{A}"; }}\npwd = x',
    f'class C:\n    def f(self):\n        self.k = "{A}"\n    def g(self):\n        pwd = self.k', f"pwd={A} & wait",
])
def test_one_literal(text):
    assert found(text) == [A]


@pytest.mark.parametrize("text", [
    f'db_pwd = "{A}" + "{B}"', f'db_pwd = "{A}" . "{B}";', f'db_pwd = ("{A}"\n          "{B}")', f'const dbPwd = "{A}" +\n  "{B}";',
    f"pwd: >\n  {A}\n  {B}\nport: 1", f"db:\n  pwd: |-\n    {A}\n\n    {B}\n  port: 1", f'db_pwd = """\n{A}\n{B}\n"""',
    f'a = "{A}"\ndb_pwd = a + "{B}"', f'a = "{A}"\ndb_pwd = "{B}" + a',
])
def test_literals_of_two_parts(text):
    assert sorted(found(text)) == sorted([A, B])


@pytest.mark.parametrize("text", [
    f'def f(): x = "{A}"\ndef g(): db_pwd = x', f'def f():\n    x = "{A}"\n\n    return x\ndef g():\n    pwd = x',
    f"function f() {{ const x = '{A}'; }}\nfunction g() {{ pwd = x; }}", f"f = (a) => {{ x = '{A}' }}\npwd = x",
    f'func f(a int) string {{ x := "{A}" }}\npwd = x', f'color = "{A}"', 'pwd = """some words of prose\nand more"""', "<pwd></pwd>", "pwd: |\nport: 1",
    "", "pwd =", "pwd: >", 'pwd = "', '"""', "}}}", "def", "<pwd>",
])
def test_no_literal(text):
    assert found(text) == []


def program(rng):
    """Functions in a module that assign literals and names, and the literals that reach a password."""
    names = [f"v{i}" for i in range(6)]
    lines, facts = [], []  # facts: (function or None, name, literal or None, other name)
    for function in (None, "f", "g", None):
        if function:
            lines.append(f"def {function}():")
        for _ in range(rng.randrange(1, 6)):
            target = rng.choice([*names, "db_pwd"])
            if rng.random() < 0.4:
                literal, other = "".join(rng.sample("abcdefghijkABCDEFGHIJK0123456789", 14)) + "xY7", None
                right = f'"{literal}"'
            else:
                literal, other = None, rng.choice(names)
                right = other
            facts.append((function, target, literal, other))
            lines.append(f"{'    ' if function else ''}{target} = {right}")
    known = {(f, n) for f, n, _, _ in facts}

    def place(function, name):
        return (function, name) if (function, name) in known else (None, name)

    expected = set()
    for function, name, literal, _ in facts:
        if literal:
            reached = {(function, name)}
            while more := {(f, n) for f, n, _, o in facts if o and place(f, o) in reached} - reached:
                reached |= more
            if any(n == "db_pwd" for _, n in reached):
                expected.add(literal)
    return "\n".join(lines), expected


def test_generated_programs():
    rng = random.Random(7)
    reported = 0
    for _ in range(2000):
        text, expected = program(rng)
        assert set(found(text)) == expected, text
        reported += len(expected)
    assert reported > 1000


@pytest.mark.parametrize("text", [
    "/* " * 50_000, "# " * 50_000, "// " * 50_000, '\\"' * 50_000, "' \" " * 40_000, '"""' * 40_001, 'x=""" ' * 30_000, "(){" * 50_000,
    "}" * 100_000, "<a " * 50_000, "<a>" * 50_000, "a: |\n" * 30_000, "a=(\n" * 40_000, 'a="b" + ' * 30_000, "a = a + " * 30_000,
    "\n" * 200_000, ") " * 100_000, "a" * 200_000, " " * 200_000, "".join(f"n{i} = n{i + 1}\n" for i in range(20_000)),
])
def test_time_follows_the_length(text):
    started = time.process_time()
    assert found(text) == []
    assert time.process_time() - started < 10
