import base64

import pytest

from pagemill.functions import text as tx


def test_keep_han(column):
    values = [None, "", "新闻2018年，NEWS好\t吗"]
    assert column(tx.keep_han, values) == ["", "", "新闻 年 好 吗"]


def test_strip_tags(column):
    values = [None, "\t <b>a</b>\nb<i\n>c \n", "x<y"]
    assert column(tx.strip_tags, values) == ["", " a  b c", "x<y"]


def test_strip_html(column):
    page = 'a\nb<script>var t="</p>";\n</script><p>one</p>\n\n<p>two</br>查看原文three---#= 4'
    assert column(tx.strip_html, [None, "", page]) == ["", "", "a b one\ntwo\nthree 4"]


def test_strip_html_quotes_its_phrases(column):
    assert column(lambda c: tx.strip_html(c, ("(ad)", "a.d")), ["x(ad)y aXd a.dz"]) == ["x y aXd z"]


ODD = [
    None, "", "plain words", "a<b", "a>b<c", "\t <b>a</b>\nb<i\n>c \n", "x<y\rz>w", "x<y\u2028z>w\u0085v<u>t", "<<a>b>c",
    "a\nb<script>var t=\"</p>\";\n</script><p>one</p>\n\n<p>two</br>查看原文three---#= 4", "s<script>\r</script>t</p>",
    "<a </p> b>c", "图片来源点击加载图片来源汉字a--b---查看\n原文", "新闻---联播<br>天气 \u0085", "ΑΣ \u0085", "ΑΣ<b>Β---ΓΣ\n", "a--xb---x c--- x",
    "see\nmore see  more", " \x01ÉTÉ<\u2029>é\x00",
]


@pytest.mark.parametrize("mode", ["letters", "han", "mixed"])
def test_text_untagged_for_words_has_the_words_of_stripped_text(column, mode):
    cut = [column(lambda c: tx.words(f(c), mode), ODD) for f in (tx.untagged, tx.strip_tags)]
    assert cut[0] == cut[1]
    for phrases in (("查看原文", "点击加载图片", "图片来源"), (), ("--x", "Β"), ("see more", "a"), ("",)):
        cut = [column(lambda c: tx.words(f(c, phrases), mode), ODD) for f in (tx.untagged_html, tx.strip_html)]
        assert cut[0] == cut[1], phrases


def test_squash(column):
    assert column(tx.squash, [None, " a,b\r\n\tc ", "ab"]) == ["", "abc", "ab"]


def test_site_of_cuts_trailing_empty_parts(column):
    values = [None, "", "http://h", "http://h/", "https://h/a/b", "http:///x", "http://", "/", "h/a"]
    assert column(tx.site_of, values) == [
        "", "", "http://h", "http://h", "https://h", "http://", "http:", "", "h/a",
    ]


def test_nonblank_counts_control_characters_as_blank(column):
    values = [None, "", "a", "ab", "\t a\n", "\x01\x02ab"]
    assert column(tx.nonblank, values) == [False, False, False, True, False, True]
    assert column(tx.nonblank_sql, values) == [False, False, False, True, True, True]


def test_decode_b64(column):
    good = base64.b64encode("汉 é".encode()).decode()
    bad_utf8 = base64.b64encode(b"a\xff").decode()
    assert column(tx.decode_b64, [None, "", good, "!!!", bad_utf8]) == [None, "", "汉 é", None, "a�"]


def test_words(column):
    values = [None, "", "One-Two 3 ÉTÉ", "新闻联播 abc好 天x"]
    assert column(tx.words, values) == [[], [], ["one", "two", "été"], ["新闻联播", "abc好", "天x"]]
    assert column(lambda c: tx.words(c, "han"), values)[3] == ["新闻", "闻联", "联播", "好", "天"]
    assert column(lambda c: tx.words(c, "mixed"), values)[2:] == [
        ["one", "two", "été"],
        ["新闻", "闻联", "联播", "abc", "好", "天", "x"],
    ]


def test_min_word_len_and_drop_listed(column):
    ws = [["a", "bb", "ccc"], [], None]
    assert column(lambda c: tx.min_word_len(c, 2), ws, "array<string>") == [["bb", "ccc"], [], None]
    assert column(lambda c: tx.drop_listed(c, ["bb"]), ws, "array<string>") == [["a", "ccc"], [], None]
    assert column(lambda c: tx.drop_listed(c, []), ws, "array<string>") == ws


def test_tagged_words_tolerate_a_missing_class(column):
    values = ["a/n,b/w", "a", "", "x/wj,y/v"]
    assert column(lambda c: tx.drop_tagged(tx.parse_tagged(c), "w"), values) == [["a"], ["a"], [""], ["y"]]
