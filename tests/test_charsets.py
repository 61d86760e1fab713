"""Charset detection on running text of its languages, short, broken and marked bytes."""

import codecs
import random

import pytest
from pyspark.sql import functions as F

from presswork.functions import charsets

CODECS = {"gbk": "gbk", "euc-kr": "cp949", "shift_jis": "cp932", "windows-1252": "cp1252", "tis-620": "cp874"}
TEXTS = {
    "gbk": ["北京时间昨天下午，中国足球队在客场以一比零战胜了对手，取得了本次比赛的第一场胜利。", "新华社记者报道，今年上半年全国经济运行总体平稳，居民收入稳步增长。", "公司发布公告称，董事会已经审议通过了有关议案。"],
    "big5hkscs": ["台北市政府昨天表示，今年將繼續推動公共運輸建設，希望市民多多利用。", "香港特別行政區政府發言人說，有關的法例會在下個月提交立法會審議。", "記者從有關方面了解到，這個問題已經得到了解決。"],
    "euc-kr": ["서울시는 어제 올해 대중교통 요금을 인상하지 않기로 결정했다고 밝혔다.", "정부는 이번 주에 새로운 경제 정책을 발표할 예정이다.", "그는 학교에서 한국어를 가르치고 있습니다."],
    "shift_jis": ["東京都は昨日、新しい交通計画を発表しました。今年の夏までに始まる予定です。", "日本の経済は今年も緩やかに成長すると見られている。", "カメラとコンピュータのデータをコピーしてください。"],
    "euc-jp": ["東京都は昨日、新しい交通計画を発表しました。今年の夏までに始まる予定です。", "日本の経済は今年も緩やかに成長すると見られている。", "カメラとコンピュータのデータをコピーしてください。"],
    "windows-1252": ["Le président a déclaré hier que l’économie française était en bonne santé.", "Die Behörden haben gestern die Straße für größere Fahrzeuge geöffnet.", "El año pasado la compañía abrió más de diez fábricas.", "“Quoted text” – he said… and the café was naïve"],
    "windows-1251": ["Вчера в Москве прошла встреча министров иностранных дел двух стран.", "Правительство приняло новое решение."],
    "koi8-r": ["Вчера в Москве прошла встреча министров иностранных дел двух стран.", "Правительство приняло новое решение."],
    "windows-1253": ["Η κυβέρνηση ανακοίνωσε χθες νέα μέτρα για την οικονομία."],
    "windows-1255": ["הממשלה הודיעה אתמול על תוכנית כלכלית חדשה."],
    "windows-1256": ["أعلنت الحكومة أمس عن خطة اقتصادية جديدة للعام المقبل."],
    "tis-620": ["รัฐบาลประกาศเมื่อวานนี้ว่าจะมีมาตรการใหม่"],
    "utf-8": ["北京时间昨天下午，中国足球队", "Plain ascii text only here", "Ünïcödé tëxt of some length"],
}
CASES = [(name, t) for name, texts in TEXTS.items() for t in texts]


@pytest.mark.parametrize(("name", "text"), CASES)
def test_running_text(name, text):
    raw = text.encode(CODECS.get(name, name))
    assert charsets.detected(raw) == name
    page = b"<html><body><p class='x'>" + raw + b"</p>\n<a href=/y>" + raw + b"</a></body></html>"
    assert charsets.charset(page) == name
    if name != "utf-8":
        assert charsets.detected(page * 3 + raw[:-1]) == name, "a page that was cut inside a character"


@pytest.mark.parametrize(("raw", "name"), [(b"", "utf-8"), (b"<p>\xc4\xe3</p>", "utf-8"), (b"\xb5\xc4" * 4, "utf-8"), (b"plain words in ascii", "utf-8"), (codecs.BOM_UTF8 + b"x", "utf-8-sig"), ("wide text here".encode("utf-16"), "utf-16"), (codecs.BOM_UTF32_LE + b"x\0\0\0", "utf-32"), ("日本の経済は今年も".encode("iso2022_jp"), "iso-2022-jp"), (("一" * 30).encode()[:-1], "utf-8")])
def test_short_marked_and_cut_bytes(raw, name):
    assert charsets.detected(raw) == name


@pytest.mark.parametrize("text", ["Dans mentierment de ierpation eauen éê éch des.", "La é le de de.", "Re chellement éç ééê, èêoi reoi.", "Et éçen éè eux de ou de releè " * 30, "DER!! ÖÜER!! DEN!! AUST!! PFÖÖ!! SICH!! " * 9])
def test_words_without_ascii_letters_are_latin_among_latin_ones(text):
    assert charsets.detected(text.encode("cp1252")) == "windows-1252"


def test_noise_is_taken_as_utf8():
    rng = random.Random(1)
    for n in (20, 400):
        raw = bytes(rng.randrange(128, 256) for _ in range(n))
        assert charsets.detected(raw) == "utf-8", charsets.scores(raw)


def test_declared_charsets_win_unverified_and_null_stays_null(spark):
    long = "这是一个没有声明字符集的网页，内容足够长。"
    cases = [(long.encode("gbk"), "gbk"), (b'<meta charset="GB2312">' + long.encode("big5hkscs", "replace"), "gbk"), (b"<?xml version='1' encoding='Big5'?>", "big5hkscs"), (b'<META http-equiv=x content="text/html; charset=EUC-KR">', "euc-kr"), (None, None)]
    df = spark.createDataFrame([(i, bytearray(b) if b is not None else None) for i, (b, _) in enumerate(cases)], "i int, b binary")
    got = dict(df.select("i", charsets.charset_of_bytes(F.col("b"))).collect())
    assert [got[i] for i in range(len(cases))] == [w for _, w in cases]


def test_bytes_become_text_again(spark):
    rows = [(k, t, CODECS.get(name, name)) for k, (name, t) in enumerate(CASES)] + [(900, None, "gbk"), (901, "<meta charset=nowhere> 这是一个没有声明字符集的网页", "gbk")]
    df = spark.createDataFrame(rows, "k int, t string, c string")
    got = dict(df.select("k", charsets.text_of_bytes(charsets.bytes_of_text(F.col("t"), F.col("c")))).collect())
    assert got == {k: t for k, t, _ in rows}
