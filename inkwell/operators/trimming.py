"""Noise at the ends of lines: trimming to a fixpoint, and guards on what a model wants removed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.operators.lines import LATIN, NoisePack, has, prose_score


@dataclass(frozen=True)
class TrimPack:
    """What may be cut from a line, and what must be left of it. Patterns suit Java and RE2 and match one character at least.

    Prefixes begin with ^ and suffixes end with $; each has a reason. What is left is safe if it is a heading, or has
    ``least`` signs of the script and either looks like prose or has a mark and 16 characters. The other
    patterns are signs of noise that guards ask for.
    """

    noise: NoisePack
    script: str
    least: int
    marks: str
    prefixes: tuple[tuple[str, str], ...]
    suffixes: tuple[tuple[str, str], ...]
    label: str
    site: str
    note: str
    notice: str
    meta: str
    trace: str
    quote: str = r"^\s*[“「『\"']"
    closing: str = r"^[“”\"'‘’)\]】》〉。！？~～\s]+$"


_URL = r"(?:https?://\S+|www\.\S+)"

#: Rules for Latin scripts.
LATIN_TRIM = TrimPack(
    noise=replace(
        LATIN,
        literals=LATIN.literals
        | {
            r"\s*\(?(?:end of chapter|to be continued)\)?\s*$": ("end of chapter", "to be continued"),
            rf"\s+{_URL}\s*$": ("http", "www."),
            r"\s*\([^()\n]{0,80}(?:vote|subscribe|share)[^()\n]{0,80}\)\s*$": ("(",),
            r"[,.:!\s]+(?:[Pp]lease (?:vote|subscribe|share)|[Ss]ubscribe now).{0,40}$": ("lease ", "ubscribe now"),
            r"(?:join.{0,30}(?:group|channel)|(?:group|channel).{0,20}[0-9]{5,})": ("group", "channel"),
            r"(?:please|thanks).{0,24}(?:support|vote|share|subscribe)": ("please", "thanks"),
            r"(?:https?://|www\.|[A-Za-z0-9-]+\.(?:com|net|org)(?:[^\p{L}]|$)|latest chapter|first published)": ("http", "www.", ".com", ".net", ".org", "latest chapter", "first published"),
        },
    ),
    script=r"\p{L}",
    least=16,
    marks=",.!?;",
    prefixes=(
        (rf"^(?:[Rr]ead (?:first|more) (?:at|on)|[Ff]irst published (?:at|on)) {_URL}\s+", "site_url_prefix"),
        (rf"^{_URL}\s+", "url_prefix"),
        (r"^(?:[Ll]atest (?:chapter|address)|[Nn]ew address)[:,\s]+\S{1,80}[,:\s]+", "site_prefix"),
        (r"^(?:[Pp]lease (?:vote|subscribe|share)|[Ss]ubscribe now)[^,.!?;\n]{0,30}[,.:!\s]+", "solicitation_prefix"),
        (r"^(?:ps|PS):\s*", "ps_prefix"),
    ),
    suffixes=(
        (r"\s*\(?(?:end of chapter|to be continued)\)?\s*$", "end_marker_suffix"),
        (rf"\s+{_URL}\s*$", "url_suffix"),
        (r"\s*\([^()\n]{0,80}(?:vote|subscribe|share)[^()\n]{0,80}\)\s*$", "solicitation_parenthetical_suffix"),
        (r"[,.:!\s]+(?:[Pp]lease (?:vote|subscribe|share)|[Ss]ubscribe now).{0,40}$", "solicitation_suffix"),
    ),
    label=r"^\s*[0-9]{1,7}\s*[Cc]hapter(?:\s|$)",
    site=r"(?:https?://|www\.|[A-Za-z0-9-]+\.(?:com|net|org)(?:[^\p{L}]|$)|latest chapter|first published)",
    note=r"^\s*(?:ps|PS|[Aa]uthor's note)[:\s-]*",
    notice=r"(?:join.{0,30}(?:group|channel)|(?:group|channel).{0,20}[0-9]{5,})",
    meta=r"(?:please|thanks).{0,24}(?:support|vote|share|subscribe)",
    trace=r"(?:ps|PS|subscribe|vote|share|join|https?://|www\.|latest chapter|first published)",
)

#: Rules for Chinese. The patterns and reasons; the prose of the noise pack is the caller's.
CHINESE_TRIM = TrimPack(
    noise=NoisePack(heading=r"^第[0-9０-９零〇一二三四五六七八九十百千万两]+[章节回節]", script="[一-鿿]", prose=((r"[“”「」『』]", 2), (r"[他她它我你][们]?[^，。！？；]{0,8}[道说问笑看走]", 2), (r"[^，。！？；]{6,}[，。！？；]", 1))),
    script="[一-鿿]",
    least=8,
    marks="，。！？；",
    prefixes=(
        (r"^(?:请收藏(?:本站|本书)?|请记住本站(?:域名)?|最新网址|最新章节|首发地址|本书首发|手机用户请浏览|手机用户请访问|请到.{0,10}阅读|天才一秒记住|一秒记住)[^，。！？；\n]{0,100}?(?:https?://\S+|www\.\S+|[A-Za-z0-9.-]+\.(?:com|cn|net|org|cc|io))\s+", "site_url_prefix"),
        (r"^(?:https?://\S+|www\.\S+)\s+", "url_prefix"),
        (r"^(?:最新网址|最新章节|首发地址|本书首发|请记住本站(?:域名)?|记住本站)[：:，,、\s]*\S{0,80}?[，。:：、\s]+", "site_prefix"),
        (r"^(?:手机用户请浏览|手机用户请访问|请到.{0,10}阅读|天才一秒记住|一秒记住)[^，。！？；\n]{0,80}[，。:：、\s]+", "reader_site_prefix"),
        (r"^(?:请收藏(?:本站|本书)?|求收藏|求月票|求推荐票|请投票|求订阅|求打赏)[^，。！？；\n]{0,30}[，。:：、\s]+", "solicitation_prefix"),
        (r"^(?:ps|PS)[：:]\s*", "ps_prefix"),
    ),
    suffixes=(
        (r"\s*[（(]?(?:本章完|未完待续)[）)]?\s*$", "end_marker_suffix"),
        (r"\s+(?:https?://\S+|www\.\S+)\s*$", "url_suffix"),
        (r"\s*[（(][^（）()\n]{0,80}(?:求收藏|求月票|求推荐票|请投票|求订阅|求打赏|求追读)[^（）()\n]{0,80}[）)]\s*$", "solicitation_parenthetical_suffix"),
        (r"[，。:：、\s]+(?:请收藏(?:本站|本书)?|求收藏|求月票|求推荐票|请投票|求订阅|求打赏).{0,40}$", "solicitation_suffix"),
    ),
    label=r"^\s*[0-9０-９]{1,7}\s*章(?:\s|$)",
    site=r"(?:https?://|www\.|[A-Za-z0-9-]+\.(?:com|cn|net|org|cc)(?:[^A-Za-z0-9_]|$)|最快更新|更新最快|最新网址|最新章节阅读请访问|正在手打中|刷新页面|收集并整理.{0,12}版权归|本书由.{0,20}(?:首发|请勿转载|勿转载)|仅供读者预览|下载.{0,8}24小时内删除)",
    note=r"^\s*(?:ps|PS|题外话|作者有话|作家的话)[：:\s－—_-]*",
    notice=r"(?:欢迎.{0,30}(?:书友群|读者群|小说群|QQ群|微信群)|(?:书友群|读者群|QQ群|微信群|群号).{0,20}(?:加入|加群|[0-9]{5,}))",
    meta=r"(?:(?:记得|拜托|赶紧|有票的).{0,24}(?:收藏|订阅|月票|推荐票|投票|打赏|支持正版)|(?:月票|推荐票).{0,12}(?:刷新|加更)|(?:加更|欠更).{0,20}(?:月票|推荐票|章|更)|新文.{0,30}(?:推荐票|收藏|订阅))",
    trace=r"(?:ps|PS|作者有话|题外话|求收藏|求月票|求推荐票|求订阅|求打赏|求追读|请投票|书友群|读者群|QQ群|微信群|加群|群号|收藏|月票|推荐票|订阅|打赏|追更|催更|https?://|www\.|最新网址|首发地址|本书首发|请记住本站)",
)


def bare(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.btrim(text, F.lit(" \t\n\x0b\f\r\u3000"))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value that is formed once, and only where it is asked for."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def safe_remainder(text: Column, pack: TrimPack) -> Column:
    """Whether what is left of a line may stand alone. What costs least and holds most often is asked first."""
    # As many signs as it takes, each followed by whatever is none; the rest of a long line isn't counted.
    signs = text.rlike(rf"(?:(?:{pack.script})(?:(?!{pack.script})[\s\S])*+){{{pack.least}}}")
    marked = (F.length(text) >= 16) & text.rlike(f"[{pack.marks}]")
    return (signs & (marked | (prose_score(text, pack.noise) >= 2))) | text.rlike(pack.noise.heading)


#: Turns that are taken before it is asked whether a line is done.
_TURNS = 8


def _turn(state: Column, pack: TrimPack, rules: tuple[tuple[str, str], ...], front: bool) -> Column:
    """The first rule that matches and leaves something safe is applied; without one the next phase begins.

    What a rule finds and leaves are elements of arrays, so that each is formed once; later rules aren't tried behind one that fits.
    """
    text = state["text"]

    def left_by(found: Column, reason: str) -> Column:
        if front:
            return bare(F.substring(text, F.length(found) + 1, F.length(text)))
        left = bare(F.substring(text, F.lit(1), F.length(text) - F.length(found)))
        if reason != "solicitation_suffix":
            return left
        # A mark before a plea ends what is left.
        mark = F.regexp_extract(found, rf"^\s*([{pack.marks}])", 1)
        return F.when((left != "") & ~left.rlike(f"[{pack.marks}]$"), F.concat(left, mark)).otherwise(left)

    def next_state(pattern: str, reason: str) -> Column:
        """Null where the rule doesn't fit."""
        literals = [text.contains(word) for word in pack.noise.literals.get(pattern, ())]
        match = F.regexp_extract(text, pattern, 0)
        found = F.filter(F.array(F.when(reduce(or_, literals), match).otherwise("") if literals else match), lambda x: x != "")
        hits = F.transform(found, lambda x: F.struct(left_by(x, reason).alias("left"), F.struct(bare(x).alias("text"), F.lit(reason).alias("reason")).alias("span")))
        safe = F.filter(hits, lambda x: safe_remainder(x["left"], pack))
        return F.get(F.transform(safe, lambda x: F.struct(x["left"].alias("text"), F.array_append(state["spans"], x["span"]).alias("spans"), state["phase"].alias("phase"))), F.lit(0))

    stop = F.struct(text.alias("text"), state["spans"].alias("spans"), (state["phase"] + 1).alias("phase"))
    return F.coalesce(*[next_state(pattern, reason) for pattern, reason in rules], stop)


def trimmed(line: Column, pack: TrimPack = LATIN_TRIM) -> Column:
    """PR21: a line without noise at its ends: action (trim or keep), cleaned, spans (text, reason) in the order of their removal.

    Prefixes are removed again and again, then suffixes, the first rule that fits each time, as long as what is left is safe. A null line
    gives null; an empty one is kept.
    """
    text = bare(line)
    rounds = F.sequence(F.lit(0), F.floor(F.length(text) / (3 * _TURNS)).cast("int") + 1)  # a removed span has three characters at least
    begin = F.struct(text.alias("text"), F.array().cast("array<struct<text:string,reason:string>>").alias("spans"), F.lit(0).alias("phase"))

    def step(state: Column, _: Column) -> Column:
        return F.when(state["phase"] == 0, _turn(state, pack, pack.prefixes, True)).when(state["phase"] == 1, _turn(state, pack, pack.suffixes, False)).otherwise(state)

    def go_on(state: Column, _: Column) -> Column:
        return F.when(state["phase"] < 2, F.aggregate(F.sequence(F.lit(1), F.lit(_TURNS)), state, step)).otherwise(state)

    done = F.array(F.aggregate(rounds, begin, go_on))
    named = F.transform(done, lambda d: F.struct(F.when(F.size(d["spans"]) > 0, "trim").otherwise("keep").alias("action"), d["text"].alias("cleaned"), d["spans"].alias("spans")))
    return F.when(line.isNotNull(), F.get(named, F.lit(0)))


def looks_like_noise(text: Column, pack: TrimPack) -> Column:
    """Whether a span has a sign of noise."""
    weak = F.lit(False)
    for pattern in pack.noise.weak:
        weak = weak | has(text, pattern, pack.noise)
    for word in pack.noise.weak_words:
        weak = weak | F.contains(text, F.lit(word))
    return (bare(text) != "") & (text.rlike(pack.trace) | weak)


def safe_trim(line: Column, cleaned: Column, pack: TrimPack = LATIN_TRIM) -> Column:
    """FI6: whether a model's shorter line may replace a line: a part of it that may stand alone, and what goes is noise."""
    original, left = bare(line), bare(cleaned)
    at = F.instr(original, left)
    rest = bare(F.concat(F.substring(original, F.lit(1), at - 1), F.substring(original, at + F.length(left), F.length(original))))
    ok = (original != "") & (left != "") & (original != left) & (at > 0) & safe_remainder(left, pack)
    noisy = lambda removed: (removed != "") & ~((F.length(removed) <= 2) & removed.rlike(pack.closing)) & looks_like_noise(removed, pack)
    return F.coalesce(ok & _with(rest, noisy), F.lit(False))


def safe_drop(line: Column, prose: Column, frequency: Column, pack: TrimPack = LATIN_TRIM) -> Column:
    """FI6: whether a line may go because a model says so.

    Headings never go, nor does quoted speech without a site in it, nor prose without an explicit sign. Of the rest go
    repeated boilerplate, lines with an explicit sign, and lines that are no prose at all and look like noise.
    """
    def drop(site: Column, explicit: Column) -> Column:
        kept = line.rlike(pack.noise.heading) | line.rlike(pack.label) | (line.rlike(pack.quote) & ~site)
        repeated = (frequency > 0) & has(line, pack.noise.boilerplate, pack.noise)
        implicit = _with(prose, lambda points: ~(points >= 2) & (repeated | ((points == 0) & looks_like_noise(line, pack))))
        return (bare(line) != "") & ~kept & (explicit | implicit)

    others = [has(line, pattern, pack.noise) for pattern in (pack.note, pack.notice, pack.noise.soft_meta, pack.meta)]
    # Lower case holds the literals of any case.
    words = pack.noise.literals.get(pack.site, ())
    maybe = _with(F.lower(line), lambda lower: reduce(or_, [lower.contains(word) for word in words])) if words else F.lit(True)
    dropped = _with(maybe & line.rlike(f"(?i){pack.site}"), lambda site: _with(reduce(or_, others, site), lambda explicit: drop(site, explicit)))
    return F.coalesce(dropped, F.lit(False))


def guarded(action: Column, line: Column, cleaned: Column, prose: Column, frequency: Column, pack: TrimPack = LATIN_TRIM) -> Column:
    """FI6: what becomes of a line when a model says d (drop) or t (trim to ``cleaned``): drop, trim or keep."""
    return F.when((action == "d") & safe_drop(line, prose, frequency, pack), "drop").when((action == "t") & safe_trim(line, cleaned, pack), "trim").otherwise("keep")
