"""Query of the URL filter, with its rules and its labelled table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from geoloom.llm.common import table
from geoloom.llm.registry import query
from geoloom.llm.urlfilter import judge, labelled_urls, train

#: Fixed values: (host/path, verdict).
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

#: Small labelled table (1: block): hosts by topic, both classes over the same kinds of subdomain, language and ending.
LABELLED = (
    ("https://garden-notes.example.org/en/5", 0),
    ("https://www.meadow-school.example.net/en/22.html", 0),
    ("https://m.river-museum.example.com/de/39/", 0),
    ("https://blog.northern-library.example.org/de/56?page=2&ref=x", 0),
    ("https://stone-bridge.example.net/fr/73#top", 0),
    ("https://www.bird-watch.example.com/fr/90?utm_source=feed", 0),
    ("https://m.old-harbour.example.org/es/107", 0),
    ("https://blog.open-recipes.example.net/es/124.html", 0),
    ("https://village-choir.example.com/en/141/", 0),
    ("https://www.history-club.example.org/en/158?page=2&ref=x", 0),
    ("https://m.slow-travel.example.net/de/175#top", 0),
    ("https://blog.math-circle.example.com/de/192?utm_source=feed", 0),
    ("https://astronomy-night.example.org/fr/209", 0),
    ("https://www.public-radio.example.net/fr/226.html", 0),
    ("https://m.city-archive.example.com/es/243/", 0),
    ("https://blog.forest-walks.example.org/es/260?page=2&ref=x", 0),
    ("https://mountain-huts.example.net/en/277#top", 0),
    ("https://www.book-circle.example.com/en/294?utm_source=feed", 0),
    ("https://m.science-letters.example.org/de/311", 0),
    ("https://blog.music-lessons.example.net/de/328.html", 0),
    ("https://theother.example.com/fr/345/", 0),
    ("https://www.thering.example.org/fr/362?page=2&ref=x", 0),
    ("https://m.thand.example.net/es/379#top", 0),
    ("https://blog.therein.example.com/es/396?utm_source=feed", 0),
    ("https://tionary.example.org/en/413", 0),
    ("https://www.entire.example.net/en/430.html", 0),
    ("https://m.thereon.example.com/de/447/", 0),
    ("https://blog.nation.example.org/de/464?page=2&ref=x", 0),
    ("https://heron.example.net/fr/481#top", 0),
    ("https://www.throne.example.com/fr/498?utm_source=feed", 0),
    ("https://www.thstern.example.net/fr/9/", 0),
    ("https://northst.example.org/fr/32", 0),
    ("https://blog.westth.example.com/en/55.html", 0),
    ("https://m.ndhouse.example.net/en/78#top", 0),
    ("https://www.whentst.example.org/es/101?utm_source=feed", 0),
    ("https://shorent.example.com/es/124?page=2&ref=x", 0),
    ("https://blog.theshth.example.net/de/147/", 0),
    ("https://m.reason-notes.example.org/de/170", 0),
    ("https://www.tion-institute.example.com/fr/193.html", 0),
    ("https://thrent.example.net/fr/216#top", 0),
    ("https://blog.southnt.example.org/en/239?utm_source=feed", 0),
    ("https://m.hearth-st.example.com/en/262?page=2&ref=x", 0),
    ("https://www.strength-nd.example.net/es/285/", 0),
    ("https://entwhist.example.org/es/308", 0),
    ("https://blog.thnorth.example.com/de/331.html", 0),
    ("https://casino-win.example.org/en/5", 1),
    ("https://www.casino-bonus.example.net/en/22.html", 1),
    ("https://m.mega-casino.example.com/de/39/", 1),
    ("https://blog.poker-jackpot.example.org/de/56?page=2&ref=x", 1),
    ("https://slots-win.example.net/fr/73#top", 1),
    ("https://www.cheap-pills.example.com/fr/90?utm_source=feed", 1),
    ("https://m.pills-online.example.org/es/107", 1),
    ("https://blog.buy-pills.example.net/es/124.html", 1),
    ("https://cheap-meds.example.com/en/141/", 1),
    ("https://www.diet-pills.example.org/en/158?page=2&ref=x", 1),
    ("https://m.ads-track.example.net/de/175#top", 1),
    ("https://blog.track-ads.example.com/de/192?utm_source=feed", 1),
    ("https://banner-ads.example.org/fr/209", 1),
    ("https://www.click-track.example.net/fr/226.html", 1),
    ("https://m.pop-ads.example.com/es/243/", 1),
    ("https://blog.free-bets.example.org/es/260?page=2&ref=x", 1),
    ("https://live-bets.example.net/en/277#top", 1),
    ("https://www.bets-bonus.example.com/en/294?utm_source=feed", 1),
    ("https://m.sport-bets.example.org/de/311", 1),
    ("https://blog.spam-farm.example.net/de/328.html", 1),
    ("https://link-farm.example.com/fr/345/", 1),
    ("https://www.spam-mail.example.org/fr/362?page=2&ref=x", 1),
    ("https://m.mass-spam.example.net/es/379#top", 1),
    ("https://blog.adult-x.example.com/es/396?utm_source=feed", 1),
    ("https://adult-cams.example.org/en/413", 1),
    ("https://www.xxx-adult.example.net/en/430.html", 1),
    ("https://m.x-girls.example.com/de/447/", 1),
    ("https://blog.hot-adult.example.org/de/464?page=2&ref=x", 1),
    ("https://lottery-win.example.net/fr/481#top", 1),
    ("https://www.loan-fast.example.com/fr/498?utm_source=feed", 1),
)


@query("op2_url_ngram_logistic")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge(pages, train(labelled_urls(spark, LABELLED)), RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")
