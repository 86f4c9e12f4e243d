"""Chat rotation against a plain rendering in Python."""

from collections import defaultdict

from marquetry.llm.chat_rotation import rotate

TURNS = [
    (1, 0, "system", "be kind"),
    (1, 1, "ann", "hé <|im_end|> there"),
    (1, 2, "bob", None),
    (1, 2, "bob", None),
    (1, 3000, None, "x"),
    (2, 1, "system", "nobody speaks"),
    (None, None, "ann", "lost"),
    (3, 5, "ann", ""),
    (3, -2000, "bob", "before"),
]


def test_against_plain_rendering(spark):
    df = spark.createDataFrame([(*t, "extra", 1) for t in TURNS], "conv_id long, turn long, role string, text string, perspective string, size int")
    want = {}
    turns = defaultdict(list)
    for conv, turn, role, text in TURNS:
        turns[conv].append((-(1 << 70) if turn is None else turn, role or "unknown", text or ""))
    for conv, rows in turns.items():
        for who in {r for _, r, _ in rows} - {"system"}:
            out, loss = "", []
            for _, role, text in sorted(rows):
                out += "<|im_start|>" + ("system" if role == "system" else "assistant" if role == who else f"user name={role}") + "\n"
                at = len(out)
                out += text.replace("<|im_", "< |im_") + "<|im_end|>\n"
                if role == who:
                    loss.append((at, len(out) - 1))
            want[conv, who] = out, loss
    got = defaultdict(list)
    for r in rotate(df).collect():
        got[r.conv_id, r.perspective].append(r)
    assert got.keys() == want.keys()
    for key, rows in got.items():
        rows.sort(key=lambda r: r.seq)
        assert [r.seq for r in rows] == list(range(1, len(rows) + 1))
        text = "".join(r.segment for r in rows)
        assert text == want[key][0]
        assert all(text[r.begin : r.end] == r.segment for r in rows)
        assert [(r.loss_begin, r.loss_end) for r in rows if r.loss_begin is not None] == want[key][1]
    assert rotate(df.limit(0)).collect() == []


def test_very_long_turns_and_a_hot_conversation(spark):
    rows = [(1, k, "ab"[k % 2], "w " * 60_000 if k == 7 else f"t{k}") for k in range(5000)]
    got = rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 10_000
    for who in "ab":
        mine = sorted((r for r in got if r.perspective == who), key=lambda r: r.seq)
        assert [r.turn for r in mine] == list(range(5000)) and all(a.end == b.begin for a, b in zip(mine, mine[1:])) and mine[0].begin == 0
