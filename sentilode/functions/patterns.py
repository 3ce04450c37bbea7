"""Fixed values that decide what the model sees: character classes, patterns, word lists.

The classes are written as code points, so that Java, RE2 and Python regexes agree.
"""

# The white space of Python's str.split and of the regex class \S.
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Emoticons, symbols, transport, flags, and the blocks U+0023-U+0039,
# U+2000-U+206F, U+2300-U+23FF, U+2600-U+26FF, U+2700-U+27BF.
SYMBOLS = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
    r"\x{23}-\x{39}\x{2000}-\x{206F}\x{2300}-\x{23FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]+"
)

# The same runs, told by what they are not: a letter is decided by two ranges instead of all. SQL takes the form above.
SYMBOL_RUN = (
    r"[^\x{00}-\x{22}\x{3A}-\x{1FFF}\x{2070}-\x{22FF}\x{2400}-\x{25FF}\x{27C0}-\x{1F1DF}\x{1F200}-\x{1F2FF}"
    r"\x{1F650}-\x{1F67F}\x{1F700}-\x{10FFFF}]+"
)

# A link is `http` or `www` and what follows up to white space.
LINK = rf"http[^{SPACE}]+|www[^{SPACE}]+"

# A mention is `@` and word characters.
MENTION = r"@[\p{L}\p{N}_]+"

# The tokeniser splits on each single character of this class.
TOKEN_SPACE = r"[\x{09}-\x{0D}\x{20}]"
TOKEN_SPACE_CHARS = "\t\n\x0b\f\r "

# A word, or one character that is neither a word character nor white space.
WORD_OR_MARK = rf"([\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{SPACE}])"
# Purely alphabetic.
ALPHABETIC = r"^\p{L}+$"
# The vectoriser of 1- and 2-grams takes runs of two or more word characters.
VECTOR_WORD = r"([\p{L}\p{N}_][\p{L}\p{N}_]+)"
# Runs that may hold a contraction, and the runs between them.
CONTRACTION_RUN = r"([\p{L}\p{N}_']+|[^\p{L}\p{N}_']+)"

# The English stop words of Spark's StopWordsRemover.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she
her hers herself it its itself they them their theirs themselves what which who whom this that
these those am is are was were be been being have has had having do does did doing a an the and
but if or because as until while of at by for with about against between into through during
before after above below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now i'll you'll he'll she'll we'll they'll
i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't
shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()

# English contractions and what they stand for.
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot", "can't've": "cannot have",
    "could've": "could have", "couldn't": "could not", "didn't": "did not",
    "doesn't": "does not", "don't": "do not", "hadn't": "had not", "hasn't": "has not",
    "haven't": "have not", "he'd": "he would", "he'll": "he will", "he's": "he is",
    "how'd": "how did", "how'll": "how will", "how's": "how is", "i'd": "i would",
    "i'll": "i will", "i'm": "i am", "i've": "i have", "isn't": "is not",
    "it'd": "it would", "it'll": "it will", "it's": "it is", "let's": "let us",
    "might've": "might have", "mightn't": "might not", "must've": "must have",
    "mustn't": "must not", "needn't": "need not", "o'clock": "of the clock",
    "shan't": "shall not", "she'd": "she would", "she'll": "she will", "she's": "she is",
    "should've": "should have", "shouldn't": "should not", "that'd": "that would",
    "that's": "that is", "there'd": "there would", "there's": "there is",
    "they'd": "they would", "they'll": "they will", "they're": "they are",
    "they've": "they have", "wasn't": "was not", "we'd": "we would", "we'll": "we will",
    "we're": "we are", "we've": "we have", "weren't": "were not", "what'll": "what will",
    "what're": "what are", "what's": "what is", "what've": "what have",
    "when's": "when is", "where'd": "where did", "where's": "where is",
    "who'll": "who will", "who's": "who is", "who've": "who have", "why's": "why is",
    "won't": "will not", "would've": "would have", "wouldn't": "would not",
    "y'all": "you all", "you'd": "you would", "you'll": "you will", "you're": "you are",
    "you've": "you have",
}

# Without its apostrophe such a form is another word, so it is left alone.
ORDINARY_WORDS = {
    "hed", "hell", "hes", "hows", "id", "ill", "its", "lets", "shed", "shell", "wed",
    "well", "were", "whens", "whys",
}


def contraction_table() -> dict[str, str]:
    """The contractions, with and without the apostrophe (the clean chain removes it)."""
    bare = {form.replace("'", ""): text for form, text in CONTRACTIONS.items()}
    return CONTRACTIONS | {f: t for f, t in bare.items() if f not in ORDINARY_WORDS}

# The published rules of Penn Treebank tokens, in their order, as (pattern, what stands for it). The text has had
# its white space made single spaces and a space put at either end; a line break then ends a sentence. The last rules find
# each word between spaces of its own.
ABBREVIATIONS = "Mr|Mrs|Ms|Dr|Prof|St|Jr|Sr|vs|etc|Inc|Ltd|Co"
TREEBANK_RULES = [
    (r"""([.?!]["')\]}>]*) (["'(\[{<]*\p{Lu})""", "\\1\n\\2"),
    (rf"""([^\p{{L}}](?:{ABBREVIATIONS})\.)\n""", r"\1 "),
    (r"""\z""", "\n"),
    (r"""([ \n(\[{<])["]""", r"\1 `` "),
    (r"""\.\.\.""", " ... "),
    (r"""([:,])([^0-9])""", r" \1 \2"),
    (r"""([;@#$%&])""", r" \1 "),
    (r"""([^.])(\.)([\])}>"']*) *\n""", "\\1 \\2\\3 \n"),
    (r"""([?!])""", r" \1 "),
    (r"""([\]\[(){}<>])""", r" \1 "),
    (r"""--""", " -- "),
    (r"""["]""", " '' "),
    (r"""([ \n])""", r"\1\1"),
    (r"""([^'])'([ \n])""", r"\1 ' \2"),
    (r"""'([sSmMdD])([ \n])""", r" '\1\2"),
    (r"""('ll|'LL|'re|'RE|'ve|'VE|n't|N'T)([ \n])""", r" \1\2"),
    (r"""(?i) (can)(not) """, r" \1 \2 "),
    (r"""(?i) (d)('ye) """, r" \1 \2 "),
    (r"""(?i) (gim)(me) """, r" \1 \2 "),
    (r"""(?i) (gon)(na) """, r" \1 \2 "),
    (r"""(?i) (got)(ta) """, r" \1 \2 "),
    (r"""(?i) (lem)(me) """, r" \1 \2 "),
    (r"""(?i) (more)('n) """, r" \1 \2 "),
    (r"""(?i) ('t)(is) """, r" \1 \2 "),
    (r"""(?i) ('t)(was) """, r" \1 \2 "),
    (r"""(?i) (wan)(na) """, r" \1 \2 "),
]
