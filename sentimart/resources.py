"""Resource tables: stopwords, contractions, tokenizer splits, lemmas, lexicon, themes.

The reference takes these from NLP libraries at run time. Those libraries and their data files
are not available offline, so the tables are inputs here: every function that needs one takes a
DataFrame, and these seeds are the defaults. A user with the full public files passes them in
with the same schema (see FIXTURES.md section 2).

All seed content is in ``FIXED VALUES`` blocks: values that must equal the public resources the
reference relies on, stated plainly and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: English stopword list of the public NLTK corpus (179 words, original order).
# ---------------------------------------------------------------------------------------------
STOPWORDS: tuple[str, ...] = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan",
    "shan't", "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't",
    "wouldn", "wouldn't",
)

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: contraction expansion rules, applied in this order to lower-cased text
# (irregular forms first). ``'`` in a pattern stands for both the straight and the curly
# apostrophe.
# ---------------------------------------------------------------------------------------------
CONTRACTIONS: tuple[tuple[int, str, str], ...] = (
    (1, "won't", "will not"),
    (2, "can't", "cannot"),
    (3, "shan't", "shall not"),
    (4, "=ain't", "are not"),
    (5, "=y'all", "you all"),
    (6, "=let's", "let us"),
    (7, "='cause", "because"),
    (8, "=ma'am", "madam"),
    (9, "=o'clock", "of the clock"),
    (10, "=he's", "he is"),
    (11, "=here's", "here is"),
    (12, "=how's", "how is"),
    (13, "=it's", "it is"),
    (14, "=she's", "she is"),
    (15, "=that's", "that is"),
    (16, "=there's", "there is"),
    (17, "=what's", "what is"),
    (18, "=when's", "when is"),
    (19, "=where's", "where is"),
    (20, "=who's", "who is"),
    (21, "=why's", "why is"),
    (22, "=he'd", "he would"),
    (23, "=i'd", "i would"),
    (24, "=it'd", "it would"),
    (25, "=she'd", "she would"),
    (26, "=that'd", "that would"),
    (27, "=there'd", "there would"),
    (28, "=they'd", "they would"),
    (29, "=we'd", "we would"),
    (30, "=who'd", "who would"),
    (31, "=you'd", "you would"),
    (40, "n't", " not"),
    (41, "'re", " are"),
    (42, "'ll", " will"),
    (43, "'ve", " have"),
    (44, "'m", " am"),
    (50, "=gimme", "give me"),
    (51, "=gonna", "going to"),
    (52, "=gotta", "got to"),
    (53, "=lemme", "let me"),
    (54, "=wanna", "want to"),
)
#: Words without an apostrophe that the rules expand.
SLANG: tuple[str, ...] = tuple(p[1:] for _, p, _ in CONTRACTIONS if p[0] == "=" and "'" not in p)

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: whole-word splits made by the public Treebank word tokenizer on text that holds
# only letters and blanks (word -> first part, second part).
# ---------------------------------------------------------------------------------------------
TOKEN_SPLITS: tuple[tuple[str, str, str], ...] = (
    ("cannot", "can", "not"),
    ("gimme", "gim", "me"),
    ("gonna", "gon", "na"),
    ("gotta", "got", "ta"),
    ("lemme", "lem", "me"),
    ("wanna", "wan", "na"),
)

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: noun suffix rules of the public WordNet morphology (suffix -> replacement),
# in the order the lemmatizer tries them.
# ---------------------------------------------------------------------------------------------
NOUN_SUFFIX_RULES: tuple[tuple[str, str], ...] = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)

# Seed of irregular noun forms (form -> lemma). Ours; a user passes the full exception list.
LEMMA_SEED: tuple[tuple[str, str], ...] = (
    ("children", "child"),
    ("feet", "foot"),
    ("teeth", "tooth"),
    ("geese", "goose"),
    ("mice", "mouse"),
    ("women", "woman"),
    ("oxen", "ox"),
    ("criteria", "criterion"),
    ("phenomena", "phenomenon"),
)

# Seed dictionary of nouns the suffix rules may reduce to. Ours; a user passes a full one. A fixed
# dictionary makes a text's lemmas independent of the other texts of its batch.
DICTIONARY_SEED: tuple[str, ...] = tuple((
    "account ad address advert answer app battery benefit bill bonus book box boy branch brand brush bug bus business button "
    "buyer call camera car card case cat category cause change chat choice city class click client clown code color comment "
    "company complaint computer cost country coupon crash customer date day deal delay delivery detail device discount dish "
    "dog driver email employee error experience face fact family feature fee file fix friend game gift girl glass half help "
    "home hour house idea idiot image issue item job key knife lady language leaf letter life light line link list loaf login "
    "loser lunch man manager match meal menu message mile minute mistake mobile moment money month moron movie music name "
    "network news notification number offer office option order package page part party password patch payment people person "
    "phone photo picture place plan player point pony price problem process product program promise purchase question rating "
    "reason refund reply request response restaurant result review reward rule scam screen search second seller series "
    "service setting shelf shop sign site song star state step store story street student subscription system tax team "
    "thief thing time tip toy transaction trip try update user value version video view vote watch way website week wife "
    "window wish wolf woman word work worker world year"
).split())

# ---------------------------------------------------------------------------------------------
# Seed lexicon (token -> valence). The first five values are those of the public VADER lexicon
# as used in FIXTURES.md; the rest are our seed values for words found in the driver text and
# in the golden rows. A user passes the full public lexicon with the same schema.
# ---------------------------------------------------------------------------------------------
LEXICON_SEED: tuple[tuple[str, float], ...] = (
    ("idiot", -2.3),
    ("worthless", -1.9),
    ("pathetic", -2.7),
    ("stupid", -2.4),
    ("best", 3.2),
    ("disgusting", -2.4),
    ("trash", -1.5),
    ("scum", -2.8),
    ("clown", -1.0),
    ("moron", -2.2),
    ("loser", -2.4),
    ("good", 1.9),
    ("great", 3.1),
    ("love", 3.2),
    ("bad", -2.5),
    ("terrible", -2.1),
)

# ---------------------------------------------------------------------------------------------
# FIXED VALUES: VADER heuristics (public algorithm constants, Hutto & Gilbert 2014).
# ---------------------------------------------------------------------------------------------
VADER_ALPHA = 15.0           # normalisation constant of the compound score
BOOSTER_INCREMENT = 0.293    # booster / dampener step
NEGATION_SCALAR = -0.74      # multiplier after a negator
POSITIVE_THRESHOLD = 0.05    # compound >= this -> Positive
NEGATIVE_THRESHOLD = -0.05   # compound <= this -> Negative

# Seed booster words (+ increases, - decreases intensity) and negators that can survive the
# cleaning chain (the ones with apostrophes or in the stopword list cannot).
# FIXED VALUES: the one-word boosters and dampeners and the negators of the public VADER rules.
BOOSTERS_UP = (
    "absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous enormously entirely "
    "especially exceptional exceptionally extreme extremely fabulously flippin flipping frackin fracking frickin fricking "
    "friggin frigging fully fuckin fucking fuggin fugging greatly hella highly hugely incredible incredibly intensely major "
    "majorly more most particularly purely quite really remarkably so substantially thoroughly total totally tremendous "
    "tremendously uber unbelievably unusually utter utterly very"
)
BOOSTERS_DOWN = (
    "almost barely hardly kinda kindof less little marginal marginally occasional occasionally partly scarce scarcely slight "
    "slightly somewhat sorta sortof"
)
BOOSTER_SEED: tuple[tuple[str, float], ...] = tuple(
    [(w, BOOSTER_INCREMENT) for w in BOOSTERS_UP.split()] + [(w, -BOOSTER_INCREMENT) for w in BOOSTERS_DOWN.split()])
NEGATOR_SEED: tuple[str, ...] = tuple((
    "aint arent cannot cant couldnt darent despite didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neednt neither "
    "never none nope nor not nothing nowhere oughtnt rarely seldom shant shouldnt uhuh uhhuh wasnt werent without wont wouldnt"
).split())

# FIXED VALUES: phrases with a valence of their own in the public VADER rules.
PHRASE_SEED: tuple[tuple[str, float], ...] = (
    ("the shit", 3.0),
    ("the bomb", 3.0),
    ("bad ass", 1.5),
    ("yeah right", -2.0),
    ("cut the mustard", 2.0),
    ("kiss of death", -1.5),
    ("hand to mouth", -2.0),
)

# ---------------------------------------------------------------------------------------------
# Themes named in the reference's results section (theme -> token that signals it).
# ---------------------------------------------------------------------------------------------
THEMES: tuple[tuple[str, str], ...] = (
    ("price", "price"),
    ("price", "cheap"),
    ("price", "expensive"),
    ("price", "cost"),
    ("shipping", "shipping"),
    ("shipping", "delivery"),
    ("shipping", "ship"),
    ("product", "product"),
    ("product", "quality"),
    ("product", "item"),
    ("app", "app"),
    ("service", "service"),
    ("service", "support"),
)

# Themes that occur in the given documents.
TEXT_THEMES: tuple[tuple[str, str], ...] = (
    ("abuse", "idiot"),
    ("abuse", "moron"),
    ("abuse", "pathetic"),
    ("abuse", "stupid"),
    ("abuse", "worthless"),
    ("licence", "license"),
    ("licence", "licensed"),
    ("licence", "released"),
)

# FIXED VALUES: sentiment labels in the order the dashboard shows them.
SENTIMENT_LABELS: tuple[str, ...] = ("Negative", "Neutral", "Positive")

# Seed for the neutral-example sample (the reference samples with random_state=42).
SAMPLE_SEED = 42

# Golden text rows (FIXTURES.md section 4): they carry the steps that driver documents never
# exercise (URL, tag, apostrophe, emoji, Unicode blanks).
GOLDEN_TEXT: tuple[tuple[int, str | None], ...] = (
    (-1, None),
    (-2, ""),
    (-3, "   "),
    (-4, "Great APP!!!"),
    (-5, "good/bad"),
    (-6, "café 5stars"),
    (-7, "see https://x.y/z now"),
    (-8, "awwww ok"),
    (-9, "<b>Love</b> it &amp; more"),
    (-10, "a<br>b"),
    (-11, "don't can't won't"),
    (-12, "cannot pay"),
    (-13, "fast\u00a0ship"),
    (-14, "x\u3000y"),
    (-15, "ok\U0001F600\u2764\ufe0f"),
    (-16, "wow...great"),
    (-17, "<script>var a=1;</script>hi"),
    (-18, "<!-- c -->hi"),
    (-19, "2 < 3 fine"),
    (-20, "terrible products, bad shipping but great prices"),
    (-21, "the children loved these boxes and watches"),
    (-22, "I wanna love it, gonna be the best"),
    (-23, "This app is really good but never great"),
    (-24, "extremely terrible, without doubt the best"),
    (-25, "least good, hardly bad"),
    (-26, "totally bad and nothing good, absolutely great"),
    (-27, "That's great, let's go. I'd buy it; ain't bad, y'all gonna love it"),
    (-28, "never great"),
    (-29, "broken boxes and sad news about the shelves"),
    (-30, "price, delivery and service of this product: the app is cheap"),
    (-31, "phone truly looks bad ass"),
    (-32, "screen yeah right great"),
    (-33, "never really good, battery yeah right bad ass stupid idiot"),
)


def seed_df(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table as inline VALUES: a local relation, read without a job of its own."""
    names = ", ".join(c.split()[0] for c in schema.split(", "))
    types = ", ".join("CAST({0} AS {1}) AS {0}".format(*c.split()) for c in schema.split(", "))
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "\\'") + "'" if isinstance(v, str) else repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT {types} FROM VALUES {body} AS t({names})")


def dictionary_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, [(w,) for w in DICTIONARY_SEED], "token string")


def lemmas_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, LEMMA_SEED, "token string, lemma string")


def lexicon_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, LEXICON_SEED, "token string, valence double")


def boosters_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, BOOSTER_SEED, "token string, scalar double")


def negators_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, [(w,) for w in NEGATOR_SEED], "token string")


def phrases_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, PHRASE_SEED, "phrase string, valence double")


def themes_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, THEMES, "theme string, token string")


def golden_text_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GOLDEN_TEXT), T.StructType([
        T.StructField("raw_id", T.LongType(), False),
        T.StructField("review_text", T.StringType(), True),
    ]))
