"""Composed transducers against a plain enumeration of paths; clause search on long texts."""

import itertools
import random
import time

from linefold.llm import toxicity as T


def plain(symbols):
    """Every choice of one insult or threat, weighed step by step."""
    total = 0.0
    target = any(x == "TARGET" for x, _ in symbols)
    for i, (x, own) in enumerate(symbols):
        if x not in T.MARKS:
            continue
        w = own
        if any(y == "NEGATION" for y, _ in symbols[max(0, i - T.NEGATION_SPAN) : i]):
            w *= T.NEGATED
        if any(y == "REPORT" for y, _ in symbols[:i]):
            w *= T.REPORTED
        total += w * T.PATTERNS[x, target]
    return total


def test_composition_sums_all_paths():
    rnd = random.Random(1)
    clauses = [list(c) for n in range(4) for c in itertools.product(T.SYMBOLS, repeat=n)] + [[rnd.choice(T.SYMBOLS) for _ in range(rnd.randrange(4, 25))] for _ in range(500)]
    for c in clauses:
        symbols = [(x, round(rnd.uniform(0.5, 3), 3)) for x in c]
        assert abs(T.composed().weight(symbols) - plain(symbols)) < 1e-9


def paths(t, symbols):
    """(written, weight) of each accepting path."""
    at = [(t.start, (), 1.0)]
    for x in symbols:
        at = [(end, (*out, y), w * v) for s, out, w in at for end, y, v in t.arcs.get((s, x), ())]
    return sorted((out, round(w * t.final[s], 9)) for s, out, w in at if s in t.final)


def test_compose_is_one_after_the_other():
    a, b = T.hit(), T.compose(T.negation(), T.reported())
    c = T.compose(a, b)
    rnd = random.Random(2)
    for _ in range(200):
        symbols = [rnd.choice(T.SYMBOLS) for _ in range(rnd.randrange(7))]
        both = sorted((out, round(w * v, 9)) for middle, w in paths(a, symbols) for out, v in paths(b, middle))
        assert paths(c, symbols) == both


def test_target_and_insult_outweigh_either_alone():
    g = T.Grammar({"idiot": 2.0})
    assert g.clause_score("you idiot") > g.clause_score("an idiot") > 0 == g.clause_score("you there")
    assert g.clause_score("they will kill you") > g.clause_score("to kill time")


def test_long_texts_without_separators_take_linear_time():
    g = T.Grammar({"idiot": 2.0})
    took = []
    for n in (20_000, 80_000):
        text = "idiot! " * n
        t = time.perf_counter()
        assert len(g.clauses(text)) == n
        took.append(time.perf_counter() - t)
    assert took[1] < 10 * took[0]
    assert len(g.clauses("idiot " * 5_000)) == 1


def test_places_are_those_of_the_text():
    g = T.Grammar({"idiot": 2.0})
    text = "\u0130\u0130\u0130 fine. You Idiot, yes"
    assert [text[a:b] for a, b, _ in g.clauses(text)] == [" You Idiot"]


def test_threats_are_found_in_their_forms():
    g = T.Grammar({})
    for text in ("they killed you", "he is killing them", "you will be murdered", "sie töten dich", "they stabbed you", "ils tueront", "te matará"):
        assert g.clause_score(text) > 0, text
    for text in ("a skill", "material", "shot put killjoyish", "tu es"):
        assert g.clause_score(text) == (T.Grammar({}).clause_score("shot") if "shot" in text else 0), text


def made(rnd, n, toxic_if):
    """Labelled clauses of all kinds; ``toxic_if`` says which count."""
    out = []
    for _ in range(n):
        c = [("OTHER", 0.0)] * rnd.randrange(3)
        report, negated, target = rnd.random() < 0.3, rnd.random() < 0.4, rnd.random() < 0.5
        kind = rnd.choice(["INSULT", "THREAT"])
        c = [("REPORT", 0.0)] * report + [("TARGET", 0.0)] * target + [("NEGATION", 0.0)] * negated + c[:1] + [(kind, 2.0 if kind == "INSULT" else T.THREAT_WEIGHT)]
        y = toxic_if(kind, report, negated, target) if rnd.random() < 0.95 else rnd.random() < 0.5
        out.append((int(y), [c]))
    return out + [(0, [])] * n


def test_weights_follow_the_labels():
    """If negated or reported insults are labelled clean, or threats without a target, the learnt weights say so, and predictions change."""
    rnd = random.Random(4)
    first = T.Weights()
    cases = {
        "negated": lambda kind, report, negated, target: not negated,
        "reported": lambda kind, report, negated, target: not report,
        "threat": lambda kind, report, negated, target: kind == "INSULT" or target,
    }
    for name, rule in cases.items():
        examples = made(rnd, 400, rule)
        weights, coef = T.learnt(examples)
        assert getattr(weights, name) < 0.7 * getattr(first, name), name
        fixed = T.Weights(1.0, 1.0, 1.0, 1.0, 1.0, 1.0)

        def right(w, c):
            g = T.Grammar({}, c, w)
            return sum((g.rating([T.composed(w).weight(x) for x in clauses]) >= 0.5) == bool(y) for y, clauses in examples) / len(examples)

        flat = T._logistic(__import__("numpy").array([T.features([T.composed(fixed).weight(x) for x in c]) for _, c in examples]), __import__("numpy").array([y for y, _ in examples], float))
        assert right(weights, coef) > right(fixed, flat) + 0.05, name


def test_weights_stay_without_evidence():
    weights, _ = T.learnt([(1, [[("INSULT", 2.0)]])] * 20 + [(0, [])] * 50)
    assert weights.negated == T.NEGATED and weights.reported == T.REPORTED and weights.threat_target == T.PATTERNS["THREAT", True]
