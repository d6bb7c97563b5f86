"""English stems and the position lists of stems."""

import pytest

from tallyhouse.functions.stemming import stems
from tallyhouse.functions.text import lexeme_positions, term_positions

# Words and their stems by the public rules, at least one for each of them.
KNOWN = """
    caresses caress; ponies poni; ties tie; cries cri; flies fli; dogs dog; gas gas; this this; kiwis kiwi; gaps gap; us us; abyss abyss
    agreed agre; feed feed; succeed succeed; proceeds proceed; bled bled; plastered plaster; motoring motor; sing sing; inning inning
    conflated conflat; troubled troubl; sized size; hopping hop; falling fall; hissing hiss; fizzed fizz; failing fail; filing file; hoping hope
    happy happi; sky sky; say say; by by; cry cri; enjoy enjoy; youth youth; boyish boyish; yes yes
    relational relat; conditional condit; rational ration; valency valenc; hesitancy hesit; digitizer digit; conformably conform
    radically radic; differently differ; vilely vile; analogously analog; vietnamization vietnam; predication predic; operator oper
    feudalism feudal; decisiveness decis; hopefulness hope; callousness callous; formality formal; sensitivity sensit; sensibility sensibl
    triplicate triplic; formative format; formalize formal; electricity electr; electrical electr; hopeful hope; goodness good
    revival reviv; allowance allow; inference infer; airliner airlin; gyroscopic gyroscop; adjustable adjust; defensible defens
    irritant irrit; replacement replac; adjustment adjust; dependent depend; adoption adopt; communism communism; activate activ
    angularity angular; homologous homolog; effective effect; bowdlerize bowdler; probate probat; rate rate; cease ceas; controlling control; rolling roll
    generate generat; generously generous; communication communic; arsenal arsenal; consign consign; consistency consist; knightly knight
    consolatory consolatori; knots knot; national nation; biology biolog; skis ski; dying die; gently gentl; early earli; news news; only onli
    was was; is is; a a; as as; running run; runs run; runner runner; engineering engin; matrix matrix; database databas
    teacher teacher; fought fought; battle battl; astounding astound; epistle epistl; boy boy; dog dog; mad mad; monkey monkey; drama drama
"""
PAIRS = [tuple(entry.split()) for entry in KNOWN.replace("\n", ";").split(";") if entry.strip()]


def test_known_stems(spark):
    got = stems(spark.createDataFrame([(w,) for w, _ in PAIRS], "word string"))
    assert {r.word: r.stem for r in got.collect() if r.stem != dict(PAIRS)[r.word]} == {}


def test_words_of_other_kinds(spark):
    words = ["", "x", "42", "2nd", "été", "straße", "中文", "yyy", "eee", None]
    got = {r.word: r.stem for r in stems(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {w: w if w != "yyy" else "yyy" for w in words}


@pytest.fixture
def texts(spark):
    rows = [(1, "The runners were running; a runner runs"), (2, "Ponies, pony and THE PONY"), (3, None), (4, ""), (5, "the of and"), (6, "Drama of a Teacher")]
    return spark.createDataFrame(rows, "doc_id int, text string")


def test_positions_of_stems(texts):
    got = {(r.doc_id, r.lexeme): r.positions for r in lexeme_positions(texts).collect()}
    assert got == {
        (1, "runner"): [2, 6], (1, "run"): [4, 7], (2, "poni"): [1, 2, 5], (6, "drama"): [1], (6, "teacher"): [4],
    }


def test_positions_are_those_of_the_terms(texts):
    terms = sorted((r.doc_id, r.position) for r in term_positions(texts).collect())
    assert sorted((r.doc_id, p) for r in lexeme_positions(texts).collect() for p in r.positions) == terms


def test_each_word_is_stemmed_once(spark):
    many = spark.range(300).selectExpr("id AS doc_id", "repeat('running ponies happily ', 20) AS text")
    got = lexeme_positions(many)
    assert got.count() == 900 and {len(r.positions) for r in got.collect()} == {20}


def test_only_positions_of_rare_words_meet_their_stems_by_exchange(texts, monkeypatch):
    monkeypatch.setattr("tallyhouse.functions.text.COMMON", 3, raising=False)
    got = lexeme_positions(texts)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan and "LeftAnti" in plan
    assert {(r.doc_id, r.lexeme): r.positions for r in got.collect()} == {
        (1, "runner"): [2, 6], (1, "run"): [4, 7], (2, "poni"): [1, 2, 5], (6, "drama"): [1], (6, "teacher"): [4],
    }
