"""Tokenisers, script predicates and text normalisers as Column expressions (all stay in the JVM).

"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference tools: punctuation that a tokeniser skips, filler characters, words that keep their
# retroflex ending, normaliser tables.
PUNCT_A = "!,?、。！，；？：「」︰『』《》"
PUNCT_B = "!,.?！，。？;；、\"”“`·~：︰「」『』《》()（）"
FILLERS = "呃啊"
ER_WORDS = "儿女 儿子 儿孙 女儿 儿媳 妻儿 胎儿 婴儿 新生儿 婴幼儿 幼儿 少儿 小儿 儿歌 儿童 儿科 托儿所 孤儿 儿戏 儿化 台儿庄 鹿儿岛 正儿八经 吊儿郎当 生儿育女 托儿带女 养儿防老 痴儿呆女 佳儿佳妇 儿怜兽扰 儿无常父 儿不嫌母丑 儿行千里母担忧 儿大不由爷 苏乞儿".split()
ZH_PUNCT = "！？｡。＂＃＄％＆＇（）＊＋，－／：；＜＝＞＠［＼］＾＿｀｛｜｝～｟｠｢｣､、〃》「」『』【】〔〕〖〗〘〙〚〛〜〝〞〟〰〾〿–—‘’‛“”„‟…‧﹏"
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
SYMBOLS = "$€£¥￥%@#&…()*[]{}×÷+=/\\|`ˊˋˆˇˉₓ⁰¹²³⁴⁵⁶⁷⁸⁹©®™（）“”，。？！、：；【】;:,.?!\""
DIALOG_PUNCT = "()[]{}.,?·@，。、「」＃\"~-—#%_`｀×*（）［］&【】～ｌ\\"
DIALOG_FILLERS = ("ppl", "ppc", "ppb", "ppo", "<v-noise>")
LANGUAGE_CODES = {"auto": 0, "zh": 3, "en": 4, "yue": 7, "ja": 11, "ko": 12, "nospeech": 13}
WITH_ITN, WITHOUT_ITN = 14, 15

_ASCII = r"[\x00-\x08\x0B\x0C\x0E-\x1F!-\x7F]"
_TAG = r"[\x00-\x08\x0B\x0C\x0E-\x1F!-=?-\x7F]"


def in_class(chars: str) -> str:
    """Characters escaped for the inside of a regular expression's class."""
    return "".join("\\" + c if c in "\\[]^-&~\"" else c for c in chars)


def _ascii_without(puncts: str, also: str = "") -> str:
    keep = [c for c in range(0x21, 0x80) if chr(c) not in puncts + also]
    return "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F" + "".join(f"\\x{c:02X}" for c in keep) + "]"


#: ED1, ED2: letters of scripts without case are tokens of their own, tags are tokens, other runs end at the next blank or non-ASCII.
TOKEN_A = rf"(\p{{Lo}}|<{_TAG}*>?|[^\p{{Lo}}\p{{Zs}} \t\r\n<{in_class(PUNCT_A)}]{_ASCII}*)"
TOKEN_B = rf"(\p{{Lo}}|<{_ascii_without(PUNCT_B, '>')}*>?|[^\p{{Lo}}\p{{Zs}} \t\r\n<{in_class(PUNCT_B)}]{_ascii_without(PUNCT_B)}*>?)"


def tokens(text: Column, variant: str = "A") -> Column:
    """ED1 / ED2: tokens of mixed-script text."""
    return F.regexp_extract_all(text, F.lit(TOKEN_A if variant == "A" else TOKEN_B), F.lit(1))


def strip_tags(text: Column) -> Column:
    """ED3: without <...>; an unclosed '<' takes the rest."""
    return F.regexp_replace(text, "<[^>]*(>|$)", "")


def normal_tokens(toks: Column, ignore: tuple[str, ...] = (), case_sensitive: bool = False, splits: dict[str, list[str]] | None = None) -> Column:
    """ED4, FLT9: upper-cased unless case matters, without ignored tokens and tags, with some tokens replaced by several."""
    up = toks if case_sensitive else F.transform(toks, F.upper)
    drop = [w if case_sensitive else w.upper() for w in ignore]
    kept = F.filter(up, lambda t: ~t.isin(*drop)) if drop else up
    bare = F.filter(F.transform(kept, strip_tags), lambda t: t != "")
    if not splits:
        return bare
    table = F.create_map(*[x for k, v in sorted(splits.items()) for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    return F.flatten(F.transform(bare, lambda t: F.coalesce(F.element_at(table, t), F.array(t))))


def is_english_char(ch: Column) -> Column:
    """TK1."""
    return ch.rlike("^[A-Za-z]$")


#: TK2: anything that is no ASCII letter, digit, blank, angle bracket or apostrophe.
NON_LATIN = r"[^A-Za-z\p{Nd} <>']"


def mandarin_only(text: Column) -> Column:
    """TK3."""
    return F.regexp_replace(text, r"[A-Za-z\p{Nd} <>']+", "")


def non_mandarin_words(text: Column) -> Column:
    """TK4: words without any TK2 character, joined by blanks."""
    return F.array_join(F.filter(F.split(text, " "), lambda w: ~w.rlike(NON_LATIN)), " ")


def collapse_blanks(text: Column) -> Column:
    """TK8: runs of U+0020 become one; white space at either end goes."""
    return F.regexp_replace(F.regexp_replace(text, " +", " "), r"^[\s\x{A0}]+|[\s\x{A0}]+$", "")


def join_mandarin(text: Column) -> Column:
    """TK5: blanks go where neither side is an ASCII letter."""
    return F.regexp_replace(collapse_blanks(F.regexp_replace(text, r"\s+", " ")), "(?<![A-Za-z]) | (?![A-Za-z])", "")


def space_mandarin(text: Column) -> Column:
    """TK6: a blank on both sides of each TK2 character."""
    return collapse_blanks(F.regexp_replace(text, f"({NON_LATIN})", " $1 "))


def split_script(text: Column) -> Column:
    """TK7: ideographs one by one, everything else at blanks."""
    return F.regexp_extract_all(text, F.lit("([㐀-鿿]|[^㐀-鿿 ]+)"), F.lit(1))


#: TK9's own tokens: digits, ASCII punctuation but for & ' -, general and CJK punctuation.
_SINGLE = r"0-9!\"#$%()*+,./:;<=>?@\[\\\]^_`{|}~\x{2000}-\x{206F}\x{3000}-\x{303F}"


def split_timed(text: Column) -> Column:
    """TK9: as TK7, with each digit and punctuation mark a token."""
    return F.regexp_extract_all(text, F.lit(f"([㐀-鿿]|[{_SINGLE}]|[^㐀-鿿 {_SINGLE}]+)"), F.lit(1))


def ideographs(text: Column) -> Column:
    """TK10."""
    return F.regexp_extract_all(text, F.lit("([㐀-鿿])"), F.lit(1))


def characters(text: Column) -> Column:
    """TK11: the code points."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def byte_length(text: Column) -> Column:
    """TK11."""
    return F.octet_length(text)


def to_utf16(text: Column) -> Column:
    """TK12: UTF-16BE bytes; from_utf16() is the way back."""
    return F.encode(text, "UTF-16BE")


def from_utf16(data: Column) -> Column:
    return F.decode(data, "UTF-16BE")


def is_all_chinese(text: Column) -> Column:
    """TK13: only U+4E00-9FFF, at least one."""
    return text.rlike("^[一-鿿]+$")


def has_alpha(text: Column) -> Column:
    return text.rlike("[A-Za-z]")


def is_all_alpha(text: Column) -> Column:
    return text.rlike("^[A-Za-z]+$")


def is_alpha_or_punct(text: Column) -> Column:
    return text.rlike(r"^[A-Za-z!-/:-@\[-`{-~]+$")


def is_alpha_or_digit(text: Column) -> Column:
    return text.rlike("^[A-Za-z0-9]+$")


def is_alpha_digit_blank(text: Column) -> Column:
    return text.rlike("^[A-Za-z0-9 ]+$")


def needs_tail_blank(text: Column) -> Column:
    """TK13: a word of ASCII letters or digits is set off by a blank."""
    return text.rlike("[A-Za-z0-9]$")


def merge_words(words: Column, mask: Column) -> Column:
    """TK14: each word joined to the one before where its mask is 1."""
    pairs = F.zip_with(words, mask, lambda w, m: F.struct(w.alias("w"), m.alias("m")))
    empty = F.array().cast("array<string>")
    joined = F.aggregate(pairs, empty, lambda a, p: F.when((p["m"] == 1) & (F.size(a) > 0), F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.concat(F.element_at(a, -1), p["w"])))).otherwise(F.concat(a, F.array(p["w"]))))
    return joined


def punct_model_tokens(text: Column) -> Column:
    """TK15: ASCII runs whole, any other character on its own, lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"([!-\x7F]+|[^\x00-\x7F])"), F.lit(1))


def script_class(token: Column) -> Column:
    """TK19: Number, Mandarin, English, Japanese or Other, without connector characters; mixed tokens are Other."""
    bare = F.regexp_replace(token, r"[&'@℃=.\-_#+;]", "")
    latin = r"A-Za-zÀ-ÖØ-öø-ʯ"
    return (
        F.when(bare.rlike(r"^[0-9]+$"), "Number")
        .when(bare.rlike(r"^[㐀-䶿一-鿿豈-﫿]+$"), "Mandarin")
        .when(bare.rlike(f"^[{latin}]+$"), "English")
        .when(bare.rlike(r"^[ぁ-ゖ]+$"), "Japanese")
        .otherwise("Other")
    )


def zh_or_en(text: Column) -> Column:
    """TK20: zh if there is any ideograph or nothing at all, else en."""
    return F.when(text == "", "zh").when(text.rlike("[一-鿿]"), "zh").when(text.isNotNull(), "en")


def oov_characters(word: Column) -> Column:
    """TK21: a word with an ideograph becomes its characters, another stays whole."""
    return F.when(word.rlike("[一-鿿]"), characters(word)).otherwise(F.array(word))


def is_english_string(text: Column) -> Column:
    """TK22: letters of any script, ASCII punctuation and blanks only."""
    return text.rlike(r"^[\p{L}!-/:-@\[-`{-~\s]*$")


def language_code(lang: Column) -> Column:
    """TK23: the recogniser's number of a language, 0 if unknown."""
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in LANGUAGE_CODES.items() for x in kv]), lang), F.lit(0))


def itn_code(itn: Column) -> Column:
    return F.when(itn, WITH_ITN).otherwise(WITHOUT_ITN)


def tag_trailer(text: Column, lang: Column, itn: Column) -> Column:
    """TK24: a blank after English with number formatting, and after any text without it."""
    return F.when(~itn | (lang == "en"), F.concat(text, F.lit(" "))).otherwise(text)


def blank_punctuation(text: Column) -> Column:
    """TN1: each punctuation mark becomes one blank."""
    marks = ZH_PUNCT + ASCII_PUNCT
    return F.translate(text, marks, " " * len(marks))


def fold_case(text: Column, to_upper: bool = False, to_lower: bool = False) -> Column:
    """TN2."""
    if to_upper and to_lower:
        raise ValueError("text cannot be folded to both cases")
    return F.upper(text) if to_upper else F.lower(text) if to_lower else text


def remove_fillers(text: Column) -> Column:
    """TN3."""
    return F.regexp_replace(text, f"[{FILLERS}]", "")


def remove_erhua(text: Column) -> Column:
    """TN4: drops 儿, but for words that own it."""
    return F.regexp_replace(text, f"({'|'.join(ER_WORDS)})|儿", "$1")


def remove_symbols(text: Column) -> Column:
    """TN6: lower case, without symbols, then without tags of letters."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), f"[{in_class(SYMBOLS)}]", ""), "<[a-zA-Z]+>", "")


def normalize_dialog(text: Column) -> Column:
    """TN7: transcripts of spontaneous dialogue in one form: noises, fillers, unknowns, widths and blanks."""
    wide = "".join(chr(0xFF41 + i) for i in range(26)) + "".join(chr(0xFF21 + i) for i in range(26)) + "é"
    narrow = "abcdefghijklmnopqrstuvwxyz" * 2 + "e"
    t = F.regexp_replace(F.lower(text), r"\(pp[\p{L}\p{N}_]+\)", "<noise>")
    t = F.regexp_replace(t, r"<pp[\p{L}\p{N}_]+>", "<noise>")
    t = F.translate(t, DIALOG_PUNCT, " " * len(DIALOG_PUNCT))
    t = F.regexp_replace(t, r"[\x00-\x1f\x7f-\x9f]", "")
    words = F.filter(F.split(t, r"[\s\x{A0}\x{3000}]+"), lambda w: w != "")
    t = F.array_join(F.transform(words, lambda w: F.when(w.isin(*DIALOG_FILLERS), "<noise>").otherwise(w)), " ")
    t = F.translate(t, wide, narrow)
    t = F.replace(F.replace(t, F.lit("<unl>"), F.lit("<unk>")), F.lit("< unk >"), F.lit("<unk>"))
    t = space_mandarin(F.regexp_replace(t, "<unk[a-z ]+>", "<unk>"))
    return F.regexp_replace(t, "<noise>(?: <noise>)+(?= |$)", "<noise>")


#: TN9: order of fields when a tagged token is spoken (TN) or written (ITN), by type of token.
SPOKEN_ORDER = {"date": ("year", "month", "day"), "fraction": ("denominator", "numerator"), "measure": ("denominator", "numerator", "value"), "money": ("value", "currency"), "time": ("noon", "hour", "minute", "second")}
WRITTEN_ORDER = {"date": ("year", "month", "day"), "fraction": ("sign", "numerator", "denominator"), "measure": ("numerator", "denominator", "value"), "money": ("currency", "value"), "time": ("hour", "minute", "second", "noon")}


def tagged_fields(token: Column) -> Column:
    """TN9: ARRAY<STRUCT<k, v>> of one tagged token ``name { key: "value" ... }``, with escapes undone."""
    found = F.regexp_extract_all(token, F.lit(r'(\w+: "(?:[^"\\]|\\.)*+")'), F.lit(1))
    return F.transform(found, lambda s: F.struct(F.regexp_extract(s, r"^(\w+):", 1).alias("k"), F.regexp_replace(F.regexp_extract(s, r'"(.*)"$', 1), r"\\(.)", "$1").alias("v")))


_TOKEN = r'\w+ \{(?:\s*\w+: "(?:[^"\\]|\\.)*+")*+\s*\}'


def reorder_tagged(text: Column, written: bool = True) -> Column:
    """TN9: each tagged token of a text with its fields in its type's order, those outside the order left out; types without
    an order keep the input's."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(f"({_TOKEN})"), F.lit(1)), lambda t: _reordered(t, written)), " ")


def _reordered(token: Column, written: bool) -> Column:
    name = F.regexp_extract(token, r"^\s*(\w+)\s*\{", 1)
    fields = tagged_fields(token)
    orders = WRITTEN_ORDER if written else SPOKEN_ORDER
    chosen = fields
    for kind, order in orders.items():
        wanted = F.slice(fields, 1, 0)
        for key in order:
            wanted = F.concat(wanted, F.filter(fields, _is_key(key)))
        chosen = F.when(name == kind, wanted).otherwise(chosen)
    body = F.array_join(F.transform(chosen, lambda f: F.concat(f["k"], F.lit(': "'), f["v"], F.lit('"'))), " ")
    return F.concat(name, F.lit(" { "), body, F.lit(" }"))


def _is_key(key: str):
    return lambda f: f["k"] == key


def latin_punctuation(text: Column) -> Column:
    """TN10."""
    return F.translate(text, "，。、？", ",.,?")


def safe_name(path: Column, most: int = 15) -> Column:
    """TN13, SNK14: a path with a blank gets '-' for blanks, and for dots in the name, which is cut short; others stay."""
    folder = F.replace(F.regexp_extract(path, r"^(.*/)?[^/]*$", 1), F.lit(" "), F.lit("-"))
    base = F.regexp_extract(path, r"([^/]*)$", 1)
    stem = F.regexp_extract(base, r"^(.+?)(\.[^.]*)?$", 1)
    ext = F.substring(base, F.char_length(stem) + 1, F.char_length(base))
    return F.when(path.contains(" "), F.concat(folder, F.substring(F.translate(stem, " .", "--"), 1, most), F.replace(ext, F.lit(" "), F.lit("-")))).otherwise(path)


def split_fields(text: Column, sep: str = " ", keep_empty: bool = True, keep_tail: bool = True) -> Column:
    """TN14: pieces between separators; empty ones kept, dropped, or dropped only at the end."""
    quoted = "\\Q" + sep + "\\E"
    parts = F.split(text, quoted)
    if not keep_empty:
        return F.filter(parts, lambda p: p != "")
    if not keep_tail:
        return F.split(F.regexp_replace(text, f"(?:{quoted})+$", ""), quoted)
    return parts
