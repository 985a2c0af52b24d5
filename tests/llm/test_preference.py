import random

from pyspark.sql import functions as F

from proofline.llm import preference

SCHEMA = "pair_id long, turn long, role string, text string"


def _render(turns):
    text, mask = "", []
    for role, said in turns:
        role, said = role or "unknown", (said or "").replace("<|", "< |")
        text += f"<|{role}|>\n"
        begin = len(text)
        text += f"{said}<|end|>\n"
        if role == "assistant":
            mask.append((begin, len(text)))
    return text, mask


def brute(chosen, rejected):
    result = {}
    for pair in {r[0] for r in chosen + rejected if r[0] is not None and r[1] is not None}:
        sides = []
        for rows in (chosen, rejected):
            turns = {}
            for p, turn, role, text in rows:
                if p == pair and turn is not None:
                    said = (role if role is not None else "unknown", text if text is not None else "")
                    turns[turn] = min(turns.get(turn, said), said)
            sides.append(turns)
        first = min((t for t in {*sides[0], *sides[1]} if sides[0].get(t) != sides[1].get(t)), default=None)
        order = [sorted(s.items()) for s in sides]
        prompt = [said for t, said in order[0] if first is None or t < first]
        tails = [_render([said for t, said in o if first is not None and t >= first]) for o in order]
        result[pair] = (len(prompt), _render(prompt)[0], *tails[0], *tails[1])
    return result


def test_equals_brute_force(spark):
    rng = random.Random(7)
    chosen, rejected = [], []
    for pair in range(120):
        for turn in range(rng.randrange(0, 7)):
            row = (pair, turn * 2, rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "bé", "x <|end|> y", "", None]))
            chosen.append(row)
            if rng.random() < 0.85:
                rejected.append(row if rng.random() < 0.8 else (*row[:3], "other"))
            if rng.random() < 0.1:
                chosen.append(row)
    chosen += [(None, 1, "user", "a"), (3, None, "user", "a")]
    rejected.append((500, 0, "user", "only here"))
    frames = [spark.createDataFrame(rows, SCHEMA).withColumn("prompt", F.lit(1)).repartition(3) for rows in (chosen, rejected)]
    got = {}
    for r in preference.format_pairs(*frames).collect():
        masks = [[tuple(x) for x in m] for m in (r.chosen_mask, r.rejected_mask)]
        got[r.pair_id] = (r.n_prompt_turns, r.prompt, r.chosen, masks[0], r.rejected, masks[1])
    assert got == brute(chosen, rejected)
    assert preference.format_pairs(*[f.limit(0) for f in frames]).count() == 0
