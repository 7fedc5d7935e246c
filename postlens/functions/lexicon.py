"""Word lists, placeholders and small dictionaries.

Larger dictionaries are passed by the caller as a mapping (Column form) or as a
table (``operators.lexicon.rewrite_tokens``).
"""

# Label codes.
LABEL_CODES = {"No": 0, "Yes": 1}

# Placeholders written by the masking steps.
EMAIL_MARK = "{{EMAIL}}"
HANDLE_MARK = " {{HANDLE}}"
HASHTAG_MARK = " {{HASHTAG}}"
URL_MARK = "{{URL}}"
MARKUP_MARK = "{{MARKUP}}"

# The English stop words published with the Natural Language Toolkit (its corpus of
# stop words is in the public domain), plus one domain word.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
panasonic
""".split()

# English contractions.
CONTRACTIONS = {
    "ain't": "are not",
    "aren't": "are not",
    "can't": "cannot",
    "couldn't": "could not",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'll": "he will",
    "he's": "he is",
    "how's": "how is",
    "i'd": "i would",
    "i'll": "i will",
    "i'm": "i am",
    "i've": "i have",
    "isn't": "is not",
    "it'd": "it would",
    "it'll": "it will",
    "it's": "it is",
    "let's": "let us",
    "mightn't": "might not",
    "mustn't": "must not",
    "needn't": "need not",
    "shan't": "shall not",
    "she'd": "she would",
    "she'll": "she will",
    "she's": "she is",
    "should've": "should have",
    "shouldn't": "should not",
    "that's": "that is",
    "there's": "there is",
    "they'd": "they would",
    "they'll": "they will",
    "they're": "they are",
    "they've": "they have",
    "wasn't": "was not",
    "we'd": "we would",
    "we'll": "we will",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what's": "what is",
    "where's": "where is",
    "who's": "who is",
    "won't": "will not",
    "wouldn't": "would not",
    "you'd": "you would",
    "you'll": "you will",
    "you're": "you are",
    "you've": "you have",
}

# Emoji and their short names.
EMOJI = {
    "😀": "grinning face",
    "😁": "beaming face with smiling eyes",
    "😂": "face with tears of joy",
    "😃": "grinning face with big eyes",
    "😄": "grinning face with smiling eyes",
    "😅": "grinning face with sweat",
    "😉": "winking face",
    "😊": "smiling face with smiling eyes",
    "😍": "smiling face with heart-eyes",
    "😎": "smiling face with sunglasses",
    "😐": "neutral face",
    "😒": "unamused face",
    "😔": "pensive face",
    "😞": "disappointed face",
    "😠": "angry face",
    "😡": "enraged face",
    "😢": "crying face",
    "😤": "face with steam from nose",
    "😩": "weary face",
    "😭": "loudly crying face",
    "😱": "face screaming in fear",
    "🙄": "face with rolling eyes",
    "🙏": "folded hands",
    "🤔": "thinking face",
    "🤦": "person facepalming",
    "🤬": "face with symbols on mouth",
    "👍": "thumbs up",
    "👍🏽": "thumbs up: medium skin tone",
    "👎": "thumbs down",
    "👏": "clapping hands",
    "💔": "broken heart",
    "💯": "hundred points",
    "🔥": "fire",
    "🎉": "party popper",
    "❤": "red heart",
    "❤️": "red heart",
    "☹️": "frowning face",
    "✅": "check mark button",
    "❌": "cross mark",
}

# Noun lemmas that a plural rule alone would get wrong, and common plurals.
LEMMAS = {
    "batteries": "battery",
    "children": "child",
    "clicks": "click",
    "companies": "company",
    "days": "day",
    "errors": "error",
    "feet": "foot",
    "hours": "hour",
    "issues": "issue",
    "laptops": "laptop",
    "men": "man",
    "mice": "mouse",
    "minutes": "minute",
    "months": "month",
    "people": "people",
    "phones": "phone",
    "problems": "problem",
    "products": "product",
    "purchases": "purchase",
    "screens": "screen",
    "services": "service",
    "signups": "signup",
    "teeth": "tooth",
    "times": "time",
    "tvs": "tv",
    "views": "view",
    "weeks": "week",
    "women": "woman",
    "years": "year",
}
