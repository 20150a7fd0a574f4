"""URL filters: rules by host and path, and a logistic regression on hashed character n-grams of both.

Everything that touches pages is DataFrame expressions. The regression is fitted on the driver, from a labelled table
of at most MAX_LABELLED urls; its weights travel as one array literal of BUCKETS numbers.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 13
GRAM = 4
MAX_LABELLED = 10_000

#: Words of the labelled urls: what ordinary hosts are named after, what unwanted ones advertise, and what both add.
ORDINARY = """
academy airport almanac alphabet archive arts astronomy atlas bakery ballet bank basket beach bicycle biology bookshop botany bridge
cabinet calendar camera canal castle cathedral chemistry choir cinema city classroom clinic coffee college community concert
cooking council country crafts culture dentist design dictionary diary doctor economy education embassy energy engineer
evening factory family festival fishing flower football forest forum gallery garden gazette geography geology gymnastics
geometry glacier golf government grammar guide harbour health heritage history hockey homework hospital hotel house
institute island journal justice kitchen laboratory lakes language law lecture letters library linden literature magazine
market mathematics medicine meteo mountain museum music nature newspaper notes nursery observatory ocean opera orchard
orchestra parents park parcel parliament photography physics piano planet poetry police pottery press primary project radio railway
reading research restaurant review river sailing school science sculpture seaside season sessions society software sports station stories
student studio summer teacher technology tennis theatre ticket tourism town trade traveller university valley village
violin volunteer weather wedding wildlife wiki wood workshop writer zoology credits essays sussex hackney linked lines
repair report stock stocking popular poplar hoist singing single scarf cam campus loaner leading prism private slope date dates update
""".split()
UNWANTED = """
bingo poker roulette blackjack baccarat slots slotmachine jackpot lottery lotto raffle sweepstakes gamble gambling gambler wager bookmaker
sportsbook croupier highroller porn porno pornstar xxx sexy sexcam nude naked erotic escort hookup webcam camgirl hentai fetish
stripper viagra cialis levitra kamagra tramadol xanax valium steroids pharma pharmacy rxmeds painkiller weightloss slimming fatburner
miracle detox enlargement potency payday loans lender cashadvance fastcash moneymaker earnmoney getrich doubler bitcoin crypto forex
ponzi millionaire giveaway prize prizes voucher giftcard coupon discount replica counterfeit knockoff rolex warez keygen cracked
torrent serialz malware trojan phishing popup popunder banner clickbank clickfraud traffic backlink linkbuilding followers telemarketer
robocall scam hoax fakeid fakes hotsingles singles dating affair flirt
""".split()
TAILS = "online now best direct club shop zone hub world pro central point".split()


def _invented(count: int, draw: random.Random) -> list[str]:
    """Names without meaning: four to six syllables."""
    syllable = lambda: draw.choice("b c d f g h k l m n p r s t v w z th sh st tr br pl".split()) + draw.choice("a e i o u ea ou io".split()) + draw.choice(["", "", "n", "r", "s", "t", "l", "nd", "ng", "sh", "nt", "th"])
    return ["".join(syllable() for _ in range(draw.randint(4, 6))) for _ in range(count)]


def labelled_urls(seed: int = 4) -> list[tuple[str, int]]:
    """A table of some 4,000 urls, 1 for those to block, made by rule from the words above.

    Hosts are one or two words of a kind, or a word and a tail that both kinds have, joined by a hyphen or by nothing; ends and paths are the same
    for both kinds. No word, host, end of a host or path is taken from a table that is judged.
    """
    draw = random.Random(seed)
    ends = lambda: draw.choice(["com", "net", "org", "info", "io", "biz", "co.uk", "de", "fr", "it", "nl"])
    path = lambda: draw.choice(["", "", "index", "item/", "about/", "post-", "2021/"]) + draw.choice(["", str(draw.randint(1, 9999))]) + draw.choice(["", "/", ".html"])
    lead = lambda: draw.choice(["", "", "www.", "blog.", "m.", "shop."])
    joint = lambda: draw.choice(["", "-"])

    def names(words: list[str], each: int) -> list[str]:
        others = lambda w: draw.choice([x for x in words if x != w])
        return [n for w in words for k in range(each) for n in [w + ("" if k % 3 == 0 else joint() + (draw.choice(TAILS) if k % 3 == 1 else others(w)))]]

    ordinary = names(ORDINARY, 6) + _invented(900, draw)
    unwanted = names(UNWANTED, 15)
    return [(f"https://{lead()}{name}.{ends()}/{path()}", y) for y, some in ((0, ordinary), (1, unwanted)) for name in some]


#: Rules as (verdict, rule): a host and a leading part of the path.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to /, ? or #, A-Z lower-cased; path: from there up to ? or #. Both empty without ://."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does. Of equally long rules the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])) if rules else []:
        cut = text.index("/")
        fits = ((host == text[:cut]) | host.endswith("." + text[:cut])) & path.startswith(text[cut:])
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def feature_text(host: Column, path: Column) -> Column:
    """What the grams are taken of: host and path between marks, digits all alike."""
    return F.concat(F.lit("^"), host, F.regexp_replace(path, "[0-9]+", "0"), F.lit("$"))


def _hash(codes: list[int]) -> int:
    h = 0
    for c in codes:
        h = (h * 131 + c) % 1_000_003
    return h % BUCKETS


def _grams(url: str) -> list[int]:
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url)
    host, path = (m[1], m[2]) if m else ("", "")
    text = "^" + re.sub("[A-Z]+", lambda x: x[0].lower(), host) + re.sub("[0-9]+", "0", path) + "$"
    return [_hash([ord(c) for c in text[i : i + GRAM]]) for i in range(max(0, len(text) - GRAM + 1))]


@lru_cache(maxsize=1)
def own_model() -> tuple[float, list[float]]:
    """The model of the labelled table above."""
    return train(labelled_urls())


def train(labelled: list[tuple[str, int]], epochs: int = 30, rate: float = 0.5, decay: float = 1e-4) -> tuple[float, list[float]]:
    """Bias and weights of the regression; features are shares of grams by bucket, times 10. Reruns agree."""
    if len(labelled) > MAX_LABELLED:
        raise ValueError(f"the labelled table is for at most {MAX_LABELLED} urls")
    rows = []
    for url, y in sorted(labelled):
        grams = _grams(url)
        counts: dict[int, float] = {}
        for g in grams:
            counts[g] = counts.get(g, 0.0) + 10.0 / len(grams)
        rows.append((counts, y))
    bias, weights = 0.0, [0.0] * BUCKETS
    for _ in range(epochs):
        for counts, y in rows[::2] + rows[1::2]:
            z = bias + sum(weights[g] * v for g, v in counts.items())
            step = rate * (y - 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z)))))
            bias += 0.1 * step
            for g, v in counts.items():
                weights[g] += step * v - rate * decay * weights[g]
    return bias, [round(w, 9) for w in weights]


def block_score(text: Column, bias: float, weights: list[float]) -> Column:
    """The model's log odds that a url of this feature text is to be blocked."""
    n = F.length(text) - GRAM + 1
    codes = F.transform(F.split(text, ""), lambda c: F.when(c == "", 0).otherwise(F.ascii(c)).cast("long"))
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded into one literal

    def summed(pair):
        total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0.0), lambda acc, i: acc + F.element_at(pair["w"], (_gram_hash(pair["c"], i) % BUCKETS + 1).cast("int")))
        return total * F.lit(10.0) / n

    bound = F.transform(F.array(F.struct(codes.alias("c"), table.alias("w"))), summed)
    return F.lit(bias) + F.when(n > 0, F.element_at(bound, 1)).otherwise(0.0)


def _gram_hash(codes: Column, i: Column) -> Column:
    h = F.lit(0).cast("long")
    for k in range(GRAM):
        h = (h * 131 + F.element_at(codes, i + k)) % 1_000_003
    return h


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, labelled: list[tuple[str, int]] | None = None, threshold: float = 0.0) -> DataFrame:
    """page_id, host, path, rule, verdict of pages (page_id, url); other columns are not looked at.

    A null url, or one without ://, has an empty host and path. A rule's verdict counts before the model's, which
    blocks from a log odds above threshold on. Repeated rows are judged alike; an empty table stays empty.
    """
    rules = RULES if rules is None else rules
    bias, weights = own_model() if labelled is None else train(labelled)
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    score = block_score(feature_text(F.col("host"), F.col("path")), bias, weights)
    modelled = F.when(score > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return parts.select("page_id", "host", "path", rule.alias("rule"), F.when(verdict.isNotNull(), verdict).otherwise(modelled).alias("verdict"))
