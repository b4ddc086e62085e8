"""Stems against published examples, and against a plain implementation over a whole vocabulary."""

import porter
import pytest
from pyspark.sql import functions as F

from tallyworks.functions import stemming as S
from tallyworks.functions import text as T

# Words and the stems they are known to have.
KNOWN = {
    "was": "wa", "this": "thi", "history": "histori", "may": "mai", "city": "citi", "because": "becaus",
    "are": "ar", "has": "ha", "only": "onli", "people": "peopl", "family": "famili", "states": "state",
    "september": "septemb", "july": "juli", "january": "januari", "japan": "japan", "university": "univers",
    "general": "gener", "several": "sever", "however": "howev", "origin": "origin", "national": "nation",
    "refer": "refer", "external": "extern", "links": "link", "includes": "includ", "used": "us",
    "known": "known", "houses": "hous", "during": "dure", "made": "made", "many": "mani", "unit": "unit",
    "united": "unit", "2010s": "2010", "is": "is", "by": "by", "as": "as", "ays": "ai",
    "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
    "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform",
    "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog",
    "vietnamization": "vietnam", "predication": "predic", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal",
    "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form",
    "formalize": "formal", "electriciti": "electr", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin",
    "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular",
    "homologous": "homolog", "effective": "effect", "bowdlerize": "bowdler", "probate": "probat",
    "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "yes": "ye", "syzygy": "syzygi",
}


def both_forms(spark, tokens, revised=True):
    frame = spark.createDataFrame([(t,) for t in tokens], "token string")
    single = {r["token"]: r["stem"] for r in S.with_stem(frame, "token", revised=revised).collect()}
    arrays, stems = S.stem_arrays(frame.select("token", F.array("token").alias("tokens")), "tokens", revised)
    in_array = {r["token"]: r["stem"] for r in arrays.select("token", F.explode(stems).alias("stem")).collect()}
    assert single == in_array
    return single


def test_known_stems(spark):
    assert both_forms(spark, list(KNOWN)) == KNOWN


def test_step_2_variants(spark):
    tokens = ["conformabli", "possibli", "archaeologi", "feasibli"]
    assert both_forms(spark, tokens, True) == {
        "conformabli": "conform", "possibli": "possibl", "archaeologi": "archaeolog", "feasibli": "feasibl"
    }
    assert both_forms(spark, tokens, False) == {
        "conformabli": "conform", "possibli": "possibli", "archaeologi": "archaeologi", "feasibli": "feasibli"
    }


@pytest.mark.parametrize("revised", [True, False])
def test_whole_vocabulary_agrees_with_plain_implementation(spark, revised):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tokens = documents.select(F.explode(T.letter_digit_tokens("text")).alias("token"))
    rows = S.stem_vocabulary(tokens, revised=revised).collect()
    step_2 = {**S.STEP_2_SUFFIXES, **(S.STEP_2_REVISED if revised else S.STEP_2_PAPER)}
    wrong = [
        (r["token"], r["stem"]) for r in rows
        if porter.stem(r["token"], step_2, S.STEP_3_SUFFIXES, S.STEP_4_SUFFIXES) != r["stem"]
    ]
    assert len(rows) > 40_000
    assert wrong == []


def test_suffix_rich_words_agree_with_plain_implementation(spark):
    starts = ["b", "yb", "tr", "rel", "rely", "ay", "aba", "obso", "controll", "bab", "yy", "cyc", "ox", "miss"]
    ends = [*S.STEP_2_SUFFIXES, *S.STEP_2_REVISED, *S.STEP_3_SUFFIXES, *S.STEP_4_SUFFIXES,
            "", "s", "ed", "eed", "ing", "ies", "sses", "y", "e", "ll", "ating", "bling", "izing", "tting", "zzing"]
    tokens = sorted({a + b for a in starts for b in ends} | {a + b + "ly" for a in starts for b in ends})
    found = both_forms(spark, tokens)
    step_2 = {**S.STEP_2_SUFFIXES, **S.STEP_2_REVISED}
    wrong = {
        t: (found[t], porter.stem(t, step_2, S.STEP_3_SUFFIXES, S.STEP_4_SUFFIXES)) for t in tokens
        if found[t] != porter.stem(t, step_2, S.STEP_3_SUFFIXES, S.STEP_4_SUFFIXES)
    }
    assert wrong == {}
