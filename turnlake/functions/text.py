"""Text clean-up and the prompt features, as JVM-side column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes and `\s` matches.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters; a single space between others is passed over, as it would become a space. They are named one by one,
# as a table tells them then, and those beyond Latin-1 stand behind a test of their range. Texts of ASCII characters alone
# take the second form.
_ASCII_BLANK = r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f ]"
_BLANK = _ASCII_BLANK[:-1] + r"\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
BLANK_RUN, ASCII_BLANK_RUN = (f"{one}(?:(?<! )|(?={one})){one}*+" for one in (_BLANK, _ASCII_BLANK))

# Patterns of the feature definitions. (?iU) = ignore case, Unicode word boundaries.
CODE_BLOCK = r"(?U)```[\w+-]*\n[\s\S]*?```"
FENCE_LABEL = r"```([A-Za-z0-9_+#-]+)"
# The words that features and task rules count, found in one pass (see `marks`). The first two lookarounds change no match;
# they spare the costly word-boundary test at most places. A mark leaves out a last letter that another one may begin
# with ("write.g." holds "write" and "e.g."), or that tells "prefix" (`fi`) from "fix" and "debugger" (`debu`) from "debug".
MARKS = (
    r"(?=[acdefgimosw])(?:(?<![a-z])\b(?:(?:step by step|must|should|only|do not|examples?|act as|explain|convert|sql|debug|fix)\b"
    r"|(?:creat|generat|writ|improv|optimiz)(?=e\b)|debu(?=g))|e\.g\.|fi(?=x\b))"
)
EXAMPLES = ("example", "examples", "e.g.")
CONSTRAINTS = ("step by step", "must", "should", "only", "do not")
VERBS = ("creat", "generat", "fix", "writ", "improv", "explain", "optimiz", "convert")
ROLEPLAY = "act as"
# Letters of a text in lower case that patterns which ignore case take for s and i.
ODD_LETTERS = {"\u017f": "s", "\u0131": "i", "i\u0307": "i"}

# Spoken-language aliases.
LANGUAGE_ALIASES = {
    "english": "en", "en": "en",
    "chinese": "zh", "mandarin": "zh", "zh": "zh",
    "japanese": "ja", "ja": "ja",
    "korean": "ko", "ko": "ko",
    "french": "fr", "fr": "fr",
    "spanish": "es", "es": "es",
    "german": "de", "de": "de",
    "portuguese": "pt", "pt": "pt",
    "hindi": "hi", "hi": "hi",
}

# Code-fence labels.
FENCE_LANGUAGES = {
    "py": "python", "python": "python",
    "javascript": "javascript", "js": "javascript", "node": "javascript",
    "typescript": "typescript", "ts": "typescript",
    "sql": "sql", "postgresql": "sql", "mysql": "sql", "sqlite": "sql",
    "bash": "bash", "shell": "bash", "sh": "bash",
    "powershell": "powershell", "ps1": "powershell",
    "java": "java",
    "c#": "csharp", "csharp": "csharp",
    "cpp": "cpp", "c++": "cpp",
    "go": "go", "golang": "go",
    "rust": "rust", "php": "php", "ruby": "ruby",
    "html": "html", "css": "css", "json": "json",
    "yaml": "yaml", "yml": "yaml",
    "r": "r",
}

# Keywords in order of priority; the first one found anywhere in the text wins.
KEYWORD_LANGUAGES = (
    ("python", "python"), ("javascript", "javascript"), ("typescript", "typescript"),
    ("sql", "sql"), ("bash", "bash"), ("shell", "bash"), ("powershell", "powershell"),
    ("java", "java"), ("c++", "cpp"), ("cpp", "cpp"), ("c#", "csharp"),
    ("golang", "go"), (" go ", "go"), ("rust", "rust"), ("php", "php"), ("ruby", "ruby"),
    ("html", "html"), ("css", "css"), ("json", "json"), ("yaml", "yaml"),
)

# Frequent function words per language for texts without a language label.
STOP_WORDS = {
    "en": "the of and to is that it for with you this what how are",
    "fr": "le la les des et est dans une pour que qui avec vous sur",
    "de": "der die und das ist nicht ein eine zu mit von den auf wie",
    "es": "el los las y que en por para con una como es del se",
    "pt": "os uma não com para dos em mais como você ao seu isso um",
}
# Scripts that name their language by themselves.
SCRIPTS = {
    "ja": r"[\x{3040}-\x{30ff}]",
    "ko": r"[\x{ac00}-\x{d7af}]",
    "hi": r"[\x{0900}-\x{097f}]",
    "zh": r"[\x{4e00}-\x{9fff}]",
}
ANY_SCRIPT = r"[\x{0900}-\x{097f}\x{3040}-\x{30ff}\x{4e00}-\x{9fff}\x{ac00}-\x{d7af}]"
SCRIPT_RANGE = r"[\x{0900}-\x{d7af}]"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def strip(text: Column) -> Column:
    """Unicode-aware strip (Spark's one-argument `trim` removes spaces only).

    Spark's trim at the end of a text takes note of each of its characters, so it is left to texts whose last byte may be of
    a blank: of ASCII up to the space, of others 0x80 to 0xAF.
    """
    last = F.substring(text.cast("string").cast("binary"), -1, 1)
    blank = (last <= F.expr("X'20'")) | last.between(F.expr("X'80'"), F.expr("X'AF'"))
    return F.when(blank, F.trim(text, F.lit(BLANKS))).otherwise(F.ltrim(text, F.lit(BLANKS)))


def strip_sql(text: str) -> str:
    last = f"substring(cast(cast({text} AS string) AS binary), -1, 1)"
    blank = f"{last} <= X'20' OR {last} BETWEEN X'80' AND X'AF'"
    return f"CASE WHEN {blank} THEN btrim({text}, {literal(BLANKS)}) ELSE ltrim({literal(BLANKS)}, {text}) END"


def normalize(text: Column) -> Column:
    """Runs of whitespace to one space, then strip; NULL becomes the empty string."""
    text = F.coalesce(text, F.lit(""))
    one_space = [F.regexp_replace(text, run, " ") for run in (ASCII_BLANK_RUN, BLANK_RUN)]
    return F.trim(F.when(F.octet_length(text) == F.length(text), one_space[0]).otherwise(one_space[1]))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def token_estimate(normalized: Column) -> Column:
    """One token per four characters, rounded up."""
    return F.ceil(F.length(normalized) / 4).cast("int")


def word_count(normalized: Column) -> Column:
    """Words of an already normalized text."""
    return F.when(normalized == "", 0).otherwise(F.size(F.split(normalized, " ")))


def has_code(text: Column) -> Column:
    """A closed code fence. The cheap substring test spares most texts the regular expression."""
    text = F.coalesce(text, F.lit(""))
    return F.contains(text, F.lit("```")) & text.rlike(CODE_BLOCK)


def _plain_letters(lowered: Column) -> Column:
    for odd, letter in ODD_LETTERS.items():
        lowered = F.replace(lowered, F.lit(odd), F.lit(letter))
    return lowered


def marks(text: Column) -> Column:
    """The words of `MARKS` in a text, in order, whatever their case.

    They are looked for in the text in lower case, where patterns are cheap; but for texts with odd letters, which some of
    these words may have been written with.
    """
    text = F.coalesce(text, F.lit(""))
    lowered = F.lower(text)
    odd = reduce(Column.__or__, [F.contains(lowered, F.lit(letter)) for letter in ODD_LETTERS])
    written = F.regexp_extract_all(text, F.lit("(?iU)" + MARKS), F.lit(0))
    plain = F.transform(written, lambda word: _plain_letters(F.lower(word)))
    return F.when(odd, plain).otherwise(F.regexp_extract_all(lowered, F.lit("(?U)" + MARKS), F.lit(0)))


def count_marks(found: Column, words: Sequence[str]) -> Column:
    return F.size(F.filter(found, lambda word: word.isin(*words)))


def prompt_type(text: Column, source_type: Column, found: Column | None = None) -> Column:
    """`found`: the text's marks, if there are any at hand."""
    given = F.replace(F.lower(normalize(source_type)), F.lit(" "), F.lit("_"))
    return (
        F.when(F.array_contains(marks(text) if found is None else found, ROLEPLAY), "roleplay")
        .when(source_type != "", given)
        .otherwise("standard")
    )


def _once(value: str, name: str, use: str) -> str:
    """SQL that evaluates `value` one time for an expression `use` that reads it many times as `name`."""
    return f"get(transform(array({value}), {name} -> {use}), 0)"


def _lookup(table: dict[str, str], key: str) -> str:
    """SQL for the value of a literal table, NULL for an unknown key."""
    entries = ", ".join(f"{literal(k)}, {literal(v)}" for k, v in table.items())
    return f"try_element_at(map({entries}), {key})"


def programming_language(prompt: str, response: str = "NULL") -> Column:
    """First known fence label in the two texts (column names), else the first keyword of the priority list."""
    joined = f"concat_ws('\\n', nullif({prompt}, ''), nullif({response}, ''))"
    labels = f"transform(regexp_extract_all({joined}, {literal(FENCE_LABEL)}, 1), x -> {_lookup(FENCE_LANGUAGES, 'lower(x)')})"
    rules = " ".join(f"WHEN contains(t, {literal(word)}) THEN {literal(name)}" for word, name in KEYWORD_LANGUAGES)
    keyword = _once(f"concat(' ', lower({joined}), ' ')", "t", f"CASE {rules} END")
    return F.expr(f"""
        coalesce(
          CASE WHEN contains({joined}, '```') THEN get(filter({labels}, x -> x IS NOT NULL), 0) END,
          {keyword})""")


def detected_sql(normalized: str) -> str:
    scores = ", ".join(
        f"named_struct('hits', size(filter(words, w -> w IN ({', '.join(map(literal, known.split()))}))), 'code', '{code}')"
        for code, known in sorted(STOP_WORDS.items())
    )
    most = f"""reduce(array({scores}), named_struct('hits', 0, 'code', 'unknown'),
        (top, one) -> CASE WHEN one.hits > top.hits THEN one ELSE top END).code"""
    # One pass over the words leaves those that any language counts.
    every = ", ".join(map(literal, sorted({word for known in STOP_WORDS.values() for word in known.split()})))
    counted = f"filter(split(lower(n), ' '), w -> w IN ({every}))"
    return _once(normalized, "n", f"coalesce({by_script_sql('n')}, {_once(counted, 'words', most)})")


def by_script_sql(text: str) -> str:
    """SQL for the language that a text's script names, else NULL."""
    scripts = " ".join(f"WHEN {text} RLIKE {literal(script)} THEN '{code}'" for code, script in SCRIPTS.items())
    # Their characters have three bytes; one range is tested faster than four.
    may = f"octet_length({text}) > length({text}) + 1 AND {text} RLIKE {literal(SCRIPT_RANGE)}"
    return f"CASE WHEN {may} AND {text} RLIKE {literal(ANY_SCRIPT)} THEN CASE {scripts} END END"


def normalize_sql(text: str) -> str:
    one_space = [f"regexp_replace(coalesce({text}, ''), {literal(run)}, ' ')" for run in (ASCII_BLANK_RUN, BLANK_RUN)]
    return f"trim(CASE WHEN octet_length({text}) = length({text}) THEN {one_space[0]} ELSE {one_space[1]} END)"


def detected_language(text: str) -> Column:
    """Script first, then most stop words (ties by language code); `unknown` without any hit."""
    return F.expr(detected_sql(normalize_sql(text)))


def spoken_language(text: str, label: str, detected: str | None = None) -> Column:
    """An explicit label goes through the alias table and otherwise passes in lower case; without one the text decides:
    by `detected`, the SQL of a fitted profile (`language.Profile`), or else by stop words.
    """
    given = f"lower({normalize_sql(label)})"
    aliased = f"coalesce({_lookup(LANGUAGE_ALIASES, given)}, nullif({given}, ''), 'unknown')"
    return F.expr(f"CASE WHEN {label} <> '' THEN {aliased} ELSE {detected or detected_sql(normalize_sql(text))} END")


def clean_payload(text: Column) -> Column:
    """Drop NUL, carriage returns to line feeds; the text is not stripped. Texts without either are spared the replacing."""
    unix = F.replace(F.replace(text, F.lit("\x00"), F.lit("")), F.lit("\r\n"), F.lit("\n"))
    unix = F.replace(unix, F.lit("\r"), F.lit("\n"))
    return F.when(F.contains(text, F.lit("\x00")) | F.contains(text, F.lit("\r")), unix).otherwise(text)


def clean_label(text: Column) -> Column:
    return strip(clean_payload(text))
