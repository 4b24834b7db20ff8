"""Upper compression limits: noise of each length beside prose in several scripts."""

import random
import string

import pytest
import zstandard

from quarry.llm import quality_rules as q

PROSE = {
    "zh": "中国的长城是世界上最伟大的建筑之一，每年都有许多游客前来参观。春天的时候，山上开满了野花，孩子们在草地上奔跑，老人坐在树下聊天。我昨天去图书馆借了三本书，其中一本讲述海洋里的动物，另外两本是关于古代历史和现代科学的小说。她打算下个月搬到南方的城市工作，因为那里的气候温暖，而且公司提供住房。医生建议病人多喝水、按时吃药，并且保持充足的睡眠。火车晚点了将近两个小时，乘客们只好在候车室里等待消息。",
    "ja": "昨日の夜、雨が降り始めたので、私たちは早めに家へ帰ることにしました。駅前の小さな本屋では、古い地図や外国の雑誌も売られています。祖母は毎朝六時に起きて、庭の花に水をやりながら歌を口ずさんでいました。新しい研究によると、海の温度は過去百年で少しずつ上がり続けているそうです。会議が終わったら、資料をまとめて部長に送ってください。",
    "ru": "Вчера вечером мы долго гуляли по набережной и разговаривали о будущем нашего города. Старый рыбак рассказывал детям удивительные истории про море, корабли и далёкие острова. На следующей неделе в музее откроется выставка, посвящённая архитектуре прошлого века. Учёные предполагают, что новые лекарства помогут справиться с этой болезнью быстрее. Поезд прибыл ровно в полдень, однако встречающих на платформе почти не было.",
    "ar": "ذهب الأولاد إلى المدرسة في الصباح الباكر وكان الطقس باردا جدا. تقع المدينة القديمة على ضفاف النهر وتحيط بها أسوار عالية من الحجر. قرأت كتابا مفيدا عن تاريخ العلوم والفلسفة في العصور الوسطى. يعمل أخي مهندسا في شركة كبيرة ويسافر كثيرا بين العواصم المختلفة. أعلنت الحكومة خطة جديدة لتحسين خدمات النقل والصحة.",
    "hi": "कल शाम हम सब नदी के किनारे टहलने गए थे और वहाँ बहुत ठंडी हवा चल रही थी। मेरे दादाजी हर सुबह अखबार पढ़ते हैं और फिर बगीचे में काम करते हैं। सरकार ने गाँवों में नए विद्यालय और अस्पताल बनाने की घोषणा की है। बच्चों को कहानियाँ सुनना बहुत पसंद है, खासकर राजाओं और जंगल के जानवरों की।",
    "ko": "어제 저녁에 우리는 강가를 따라 오래 걸으며 앞으로의 계획에 대해 이야기했다. 할머니께서는 매일 아침 일찍 일어나 마당의 꽃에 물을 주신다. 새로운 연구에 따르면 바다의 온도가 지난 백 년 동안 조금씩 올라갔다고 한다. 회의가 끝나면 자료를 정리해서 부장님께 보내 주세요.",
}
ALPHABETS = {
    "printable": (bytes(range(33, 127)), 200),
    "base64": ((string.ascii_letters + string.digits + "+/").encode(), 200),
    "letters": (string.ascii_lowercase.encode(), 16_000),
}


def kept(text):
    return q.compression_verdict(text, q.Bands(), zstandard.ZstdCompressor(level=3))[3]


def noise(alphabet, size, seed):
    rng, out = random.Random(seed), b""
    while len(out) < size:
        out += bytes(rng.choices(alphabet, k=rng.randint(3, 12))) + b" "
    return out[:size]


@pytest.mark.parametrize("name", ALPHABETS)
def test_noise_goes(name):
    alphabet, least = ALPHABETS[name]
    for size in (200, 399, 600, 999, 1_000, 1_999, 2_000, 3_999, 6_000, 15_999, 16_000, 64_000, 100_000):
        if size >= least:
            assert not any(kept(noise(alphabet, size, seed)) for seed in range(3)), size


@pytest.mark.parametrize("name", PROSE)
def test_prose_of_many_scripts_stays(name):
    text = PROSE[name].encode()
    for size in (200, 300, 400, 600, len(text)):
        assert kept(text[:size]), size
