"""Sentences written by hand, none from the generator of the tables."""

import time

import pytest

from corpusloom.llm.sentences import ends

CASES = [
    ("She met Lt. Col. Harris at noon. They left.", 2),
    ("Mr. Smith saw Gen. Lee. He waved.", 2),
    ("El Sr. López y la Dra. Ruiz llegaron. Comieron.", 2),
    ("M. Dupont et Mme. Roux sont là. Ils partent.", 2),
    ("It cost 3.50 dollars. We paid.", 2),
    ("See Fig. 3 and Eq. 2. They agree.", 2),
    ("He said: “Stop. Wait.” Then he ran.", 2),
    ("Is it late? Yes! We go.", 3),
    ("The U.S. economy grew. Prices fell.", 2),
    ("Use file main.py. It works.", 2),
    ("J. R. Smith wrote it. Good.", 2),
    ("O Prof. Silva falou. Todos ouviram.", 2),
    ("A Sra. Costa chegou às 10.30. Saiu logo.", 2),
    ("Herr Dr. Weber kam am 3. Mai. Er blieb.", 2),
    ("Siehe Abb. 4 auf S. 12. Danach folgt mehr.", 2),
    ("Pan prof. Nowak przyszedł. Usiadł.", 2),
    ("Zob. rys. 2 na str. 5. To ważne.", 2),
    ("Проф. Иванов пришёл. Он сел.", 2),
    ("См. рис. 2 на стр. 7. Это важно.", 2),
    ("وصل د. أحمد اليوم. جلس الجميع.", 2),
    ("هل هذا صحيح؟ نعم.", 2),
    ("डॉ. शर्मा आए। वे बैठे।", 2),
    ("यह ठीक है। क्यों? पता नहीं।", 3),
    ("他来了。我们走吧！", 2),
    ("他说：“走吧。”然后离开了。", 1),
    ("今日は晴れ。明日は雨？わからない。", 3),
    ("彼は「行こう。」と言った。そして出た。", 2),
    ("วันนี้อากาศดี เราไปเที่ยว", 2),
    ("เขามี 3 เล่ม แล้วกลับบ้าน", 2),
    ("Wait... what? No.", 2),
    ("A heading\n\nOne sentence here. Another one.", 3),
    ("He left (he was tired). She stayed.", 2),
    ("Born in 1990. Died in 2020.", 2),
    ("Elle vit à Paris. M. Petit aussi.", 2),
    ("¿Vienes? ¡Sí! Vale.", 3),
    ("Das kostet 1.000 Euro. Zu viel.", 2),
    ("Le prix (env. 5 euros) monte. Dommage.", 2),
]


@pytest.mark.parametrize("text, number", CASES)
def test_number_of_sentences(text, number):
    assert len(ends(text)) == number


def test_any_nesting_in_linear_time():
    began = time.time()
    deep = "He said (" * 20_000 + "so." + ")" * 20_000 + " Then he left."
    assert ends(deep)[-1] == len(deep) and time.time() - began < 10
    assert len(ends("(" * 40 + "Stay. Go." + ")" * 40 + " Done.")) == 2
