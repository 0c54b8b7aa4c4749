"""Word lists, patterns and constants.  All are parameters of the operators; these are the defaults."""

# Turkish tokens, stop words, language markers.
TURKISH_TOKEN = "[a-zçğıöşüâîûêô0-9]+"
TURKISH_STOP = (
    "ve bir bu ile için olan olarak da de mı mi mu mü ki gibi ise ancak ya veya çok daha en her tüm üzere göre kadar sonra önce dair ilişkin olduğu olduğunu şu o ne mıdır midir"
).split()
TURKISH_LETTERS = "çğıöşüÇĞİÖŞÜ"
DEACCENT_FROM, DEACCENT_TO = "çğıöşüÇĞİÖŞÜâîûÂÎÛ", "cgiosuCGIOSUaiuAIU"

#: For prose in four languages.
TOKEN = "[a-z0-9ß-öø-ÿœ]+"
STOPWORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "as", "with", "on", "be", "at", "by", "this"],
    "de": ["der", "die", "und", "das", "den", "ein", "eine", "mit", "zu", "von", "ist", "nicht", "auf", "für"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "que", "qui", "pour", "dans", "est", "pas"],
    "es": ["el", "la", "los", "de", "y", "que", "en", "un", "una", "por", "con", "para", "es", "no"],
}
ALL_STOPWORDS = sorted({w for ws in STOPWORDS.values() for w in ws})

K1, B = 1.5, 0.75
RRF = 60
#: Characters a token, output tokens an input character.
CHARS_PER_TOKEN, OUTPUT_PER_CHAR = 4.11, 0.35
SIZE_CAP, WINDOW_PARAGRAPHS, WINDOW_CHARS = 2000, 60, 30_000
PIVOT_YEAR, PENALTY = 2023, 0.4
#: Namespaces of name-based identifiers: those of the standard, under a name each.
NAMESPACE_DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
