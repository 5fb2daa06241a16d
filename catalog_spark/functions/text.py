"""Scripts, languages, levels and text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes of the scripts.
SCRIPTS = {
    "hangul": "가-힣", "kana": "ぁ-んァ-ン", "han": "一-龥", "cyrillic": "А-Яа-яЁёІіЇїЄєҐґ", "arabic": "؀-ۿ",
    "devanagari": "ऀ-ॿ", "thai": "ก-๿", "latin": "A-Za-zÀ-ÿĀ-žĐđıİŞşĞğÇçÖöÜüÑñ",
}
# Languages of display texts.
LANGUAGES = {
    "ko": "Korean", "en": "English", "ja": "Japanese", "zh-Hans": "Simplified Chinese", "zh-Hant": "Traditional Chinese", "es": "Spanish",
    "fr": "French", "de": "German", "pt-BR": "Brazilian Portuguese", "ru": "Russian", "id": "Indonesian", "vi": "Vietnamese", "th": "Thai",
    "ms": "Malay", "fil": "Filipino", "hi": "Hindi", "ar": "Arabic", "it": "Italian", "nl": "Dutch", "pl": "Polish", "sv": "Swedish",
    "tr": "Turkish", "uk": "Ukrainian",
}
# Labels of course levels.
LEVELS = {
    "beginner": {"ko": "초급", "en": "Beginner", "ja": "初級", "zh-Hans": "初级", "zh-Hant": "初級"},
    "intermediate": {"ko": "중급", "en": "Intermediate", "ja": "中級", "zh-Hans": "中级", "zh-Hant": "中級"},
    "advanced": {"ko": "고급", "en": "Advanced", "ja": "上級", "zh-Hans": "高级", "zh-Hant": "高級"},
    "alllevels": {"ko": "전체 수준", "en": "All levels", "ja": "全レベル", "zh-Hans": "所有级别", "zh-Hant": "所有級別"},
}
SPACES = r"[\s\x{85}\x{A0}]+"


def script_count(text: Column, script: str) -> Column:
    """Characters of a script (a key of SCRIPTS)."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[{SCRIPTS[script]}]")), F.lit(0))


def is_native(target: str, title: Column, text: Column) -> Column:
    """Whether a course's own title and text already serve readers of ``target`` (a key of LANGUAGES)."""
    a, b = (lambda s: script_count(title, s)), (lambda s: script_count(text, s))
    if target == "ko":
        return (a("hangul") >= 4) & (a("kana") == 0) & (b("kana") == 0) & (b("han") <= 4) & (a("hangul") * 3 >= a("latin"))
    if target == "ja":
        return (b("kana") >= 2) & (b("hangul") == 0)
    if target.startswith("zh-"):
        return (b("han") >= 2) & (b("hangul") == 0) & (b("kana") == 0)
    own = {"ru": "cyrillic", "uk": "cyrillic", "ar": "arabic", "hi": "devanagari", "th": "thai"}.get(target)
    if own:
        return a(own) >= 2
    foreign = sum((b(s) for s in SCRIPTS if s != "latin"), F.lit(0))
    return (a("latin") >= 3) & (foreign == 0)


def language_code(raw: Column) -> Column:
    """The display language of a code or locale; empty for an unknown one."""
    x = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    base = F.split_part(x, F.lit("-"), F.lit(1))
    traditional = x.contains("tw") | x.contains("hk") | x.contains("mo") | x.contains("hant")
    plain = [k for k in LANGUAGES if "-" not in k]
    return (
        F.when(base == "zh", F.when(traditional, F.lit("zh-Hant")).otherwise(F.lit("zh-Hans")))
        .when(base == "pt", F.lit("pt-BR"))
        .when(base.isin("tl", "fil"), F.lit("fil"))
        .when(base.isin(*plain), base)
        .otherwise(F.lit(""))
    )


def language_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in LANGUAGES.items() for x in pair])
    return F.coalesce(F.element_at(names, language_code(code)), code)


def normalize_targets(codes: Column) -> Column:
    """Known languages of an array of codes, each once, in order."""
    return F.array_distinct(F.filter(F.transform(codes, language_code), lambda x: x != ""))


def localize_level(target: Column, raw: Column) -> Column:
    """The level's label in the target language; a level or language without one gives the trimmed input."""
    value = F.trim(F.coalesce(raw, F.lit("")))
    key = F.lower(F.regexp_replace(value, "[ _-]", ""))
    labels = F.create_map(*[F.lit(x) for k, by in LEVELS.items() for lang, label in by.items() for x in (f"{k}|{lang}", label)])
    return F.coalesce(F.element_at(labels, F.concat_ws("|", key, language_code(target))), value)


def compact_text(raw: Column, limit: int) -> Column:
    """White space collapsed, URL schemes dropped, cut to ``limit`` characters."""
    x = F.trim(F.regexp_replace(F.coalesce(raw, F.lit("")), SPACES, " "))
    for scheme in ("http://", "https://"):
        x = F.replace(x, F.lit(scheme), F.lit(""))
    return F.left(x, F.lit(limit)) if limit > 0 else x


def extract_json_object(raw: Column) -> Column:
    """From the first { to the last }, else the trimmed input."""
    found = F.regexp_extract(raw, r"(?s)\{.*\}", 0)
    return F.when(found != "", found).otherwise(F.trim(raw))


def error_text(raw: Column, limit: int, secrets: list[str] = ()) -> Column:
    """Secrets masked, white space collapsed, cut to ``limit``."""
    x = F.coalesce(raw, F.lit(""))
    for s in secrets:
        if s.strip():
            x = F.replace(x, F.lit(s.strip()), F.lit("***"))
    return F.left(F.trim(F.regexp_replace(x, SPACES, " ")), F.lit(limit))


def csv_items(raw: Column) -> Column:
    return F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")


def id_list(raw: Column) -> Column:
    """Positive whole numbers of a comma-separated text, each once, in order."""
    return F.array_distinct(F.filter(F.transform(csv_items(raw), lambda x: x.try_cast("bigint")), lambda n: n > 0))
