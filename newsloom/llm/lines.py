"""Lines of web pages by line-block distribution: which belong to the article and which to the page around it.

A body is cut at newlines and markup is stripped. Each line weighs its length in columns as far as its form is
that of running text; a link, a menu or a row of tags weighs nothing, and a cue phrase takes a notice's length
off the weight. Weights are summed over sliding windows of lines: the article begins where the sums surge and
ends where they dive, and whatever lies outside is the page's, whether a cue touches it or not.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

#: Cue phrases of page parts, after width folding and lower-casing, as patterns at the start of a line.
START_CUES = """
cookie|隐私提示|接受全部|全部接受|我们与合作方|我们使用|本站使用
字号[: ]|预计阅读|阅读时长|阅读时间|发布于|发布时间|更新于|更新时间|来源[:/]|出处[:/]|原标题
作者[:/ ]|撰文[:/ ]|文[|/:丨]|编辑[|/:丨]|责任编辑|责编|校对[:/ ]|记者[:/ ]|采写[:/ ]|摄影[:/ ]|图[|/:丨]|编译[:/ ]|本报记者|采访[|/:丨]
广告$|[-—]+ ?(?:推广|广告|ad)|推广(?:内容)?$|赞助商|本内容由.{1,20}赞助|商业推广
转载请|未经.{0,30}(?:许可|授权|允许)|本文仅代表|本文不构成|文中涉及的|以上(?:译文|内容|观点|信息)|受访者观点|本站(?:所载|内容|刊载|文章)|图片除|.{2,20}原创稿件|风险提示|免责声明|声明[::]|版权所有$|版权声明|本页(?:面)?(?:内容|文字)
备案|举报|客服|联系我们|联系电话|技术支持|关于我们|商务合作|copyright|©|\\(c\\) ?\\d{4}|.{1,20}icp备|网站地图|友情链接
喜欢这篇|觉得(?:有用|文章|不错)|读到这里|点赞|收藏 ?\\d|分享(?:到|至|给)|周末愉快|下次更新前|如果你也在|想看原始表格|每周[一二三四五六日]晚|新读者福利|加入读者群|扫码|长按识别|关注(?:公众号|我们)|识别二维码|点击(?:下方|右下|关注|查看)|欢迎(?:转发|关注)|写下你的|下载(?:app|客户端)|打开.{0,20}(?:app|客户端)|扫一扫|点一下|回复[“"「].{1,12}[”"」]|星标
登录后|注册后|全部评论|最新评论|热门评论|评论 ?[(\\d]|条评论|发表评论
相关(?:阅读|文章|推荐)|热门(?:排行|文章|推荐)|猜你喜欢|大家都在看|编辑推荐|延伸阅读|推荐阅读|更多(?:文章|阅读|精彩)|上一篇|下一篇|往期(?:回顾|推荐)
we and \\d+ partners|your privacy|by staying on this page|by continuing|we use cookies|this site uses cookies|accept all|.{2,30} stores small files|manage settings
text size|\\d+ min(?:ute)?s? read|posted (?:on )?\\d|updated (?:at |on )?\\d|published (?:at |on )?\\d|last updated|\\d[\\d.,]* (?:views|shares|comments|likes)
by [^.!?,;]{3,40}$|words: |reporting by |written by |edited by |photo(?:s|graphs?)? by |story by |text by |.{3,40}, staff reporter|additional reporting
advertisement|sponsored|paid content|story continues below|promoted
no part of this|all rights reserved|.{2,40} is published by a company|the views above|views expressed|figures quoted|statements by|translations |prices shown|text and charts|all trademarks|terms of use|privacy notice|this (?:material|article) may not|any reproduction
enjoyed this|liked the|before you go|know somebody|know someone|tap the heart|share this|pass it on|post it|tell us|follow .{2,40} (?:wherever|on )|join .{2,40} today|get our|new readers|create a free account|already a member|subscribe|sign up|download (?:the|our) app|read it offline|if you liked
sign in|log in|join the conversation|sort by|leave a comment|\\d+ comments|comments ?\\(|contact (?:the|us)|write to
related (?:stories|articles|posts)|you may also like|most (?:read|popular)|trending|more from|read (?:more|next|also)|recommended|previous article|next article|back to top|editor'?s picks|don'?t miss
alle annehmen|ablehnen|einstellungen|.{2,40} verwendet cookies|wir verwenden|ihre privatsphäre|wir und \\d+ partner
lesezeit|stand: ?\\d|veröffentlicht (?:am )?\\d|aktualisiert|\\d[\\d.,]* (?:mal geteilt|aufrufe|kommentare)|von [^.!?,;]{3,40}$|text: |redaktion: |bericht: |foto: |.{3,40}, redaktion
anzeige$|gesponsert|werbung|bezahlter inhalt
nachdruck|alle rechte|der beitrag gibt|die genannten|alle angaben|übersetzungen|impressum|datenschutz|marken gehören
gefällt ihnen|empfehlen sie|teilen sie|jeden morgen|folgen sie|jetzt die app|app laden|abonnieren|artikel teilen|melden sie sich|neu hier|noch kein
anmelden um|kommentare ?\\(|kommentar schreiben|schreiben sie|neueste zuerst
verwandte|das könnte|meistgelesen|mehr von|lesen sie auch|auch interessant|mehr zum thema|nach oben|vorheriger|nächster|weitere (?:beiträge|artikel)
aceptar todo|rechazar|configurar|.{2,40} utiliza cookies|usamos cookies|su privacidad|tu privacidad|nosotros y \\d+
lectura de|tiempo de lectura|actualizado|publicado (?:el )?\\d|\\d[\\d.,]* (?:veces compartido|vistas|comentarios)|por [^.!?,;]{3,40}$|texto(?: de|:)|edición(?: de|:)|redacción(?: de|:)|.{3,40}, enviad[oa]
publicidad|patrocinado|contenido patrocinado
prohibida la|todos los derechos|las opiniones son|las cifras citadas|los precios|las traducciones|aviso legal|privacidad|marcas pertenecen
¿?te gustó|compártelo|envíalo|comparte|recibe el boletín|recibe |síguenos|sigue a|descarga la|suscríbete|regístrate|¿?conoces a|antes de irte|nuevos lectores
inicia sesión|comentarios ?\\(|escríbenos|deja un comentario|ordenar por
también te puede|lo más leído|más de|notas relacionadas|te recomendamos|lee también|volver arriba|artículo anterior|siguiente artículo
aceitar tudo|recusar|preferências|.{2,40} usa cookies|usamos cookies|sua privacidade|nós e \\d+
\\d+ min de leitura|tempo de leitura|atualizado|publicado (?:em )?\\d|\\d[\\d.,]* (?:compartilhamentos|visualizações|comentários)|reportagem(?: de|:)|edição(?: de|:)|.{3,40}, da redação
publicidade|patrocinado|conteúdo patrocinado
é proibida|todos os direitos|as opiniões são|os valores|os preços|as traduções|termos|marcas pertencem
gostou|compartilhe|envie para|receba |siga |baixe o|assine|cadastre-se|antes de sair|conhece alguém|novos leitores
entre para|comentários ?\\(|escreva para|deixe um comentário|fale conosco
leia também|mais lidas|mais de|notícias relacionadas|você também pode|recomendadas|voltar ao topo|artigo anterior|próximo artigo
"""
#: Cue phrases that mark a short line wherever they stand.
INNER_CUES = """
使用cookie|继续访问即表示|管理偏好|发自前方|本报讯记者|\\d{4}年\\d{1,2}月\\d{1,2}日 ?\\d|· ?阅读 ?\\d|版权所有$|均由.{1,20}授权使用|不代表本站|以原始公告为准|不作为决策依据|仅供读者参考|不构成.{0,8}建议|著作权保护|联系编辑部|右下角的|领取资料包|社群直播间|小程序下载|免费试读|推荐给朋友|和朋友聊聊|存进收藏夹|转发给一位|留下一个赞|加星标|每天早上.{1,4}点见|转给正在|领\\d+天会员|\\(\\d+阅读\\)$
all rights reserved|alle rechte vorbehalten|todos los derechos reservados|todos os direitos reservados|without written consent|not financial advice|do not bind the publisher|offered for information only|can be corrected at any time|\\(\\d+ views\\)$|staff reporter at|hello@|desk@
keine anlageberatung|nur mit genehmigung|um ihre auswahl zu speichern|edited by|asesoría financiera|recomendação de investimento|sin permiso de|sem autorização de
"""
#: Headings above lists of other articles.
LIST_HEADINGS = """
相关(?:阅读|文章|推荐)|热门(?:排行|文章|推荐)|猜你喜欢|大家都在看|编辑推荐|推荐阅读|更多(?:文章|阅读|精彩)|往期(?:回顾|推荐)
related (?:stories|articles|posts)|you may also like|most (?:read|popular)|trending(?: now)?|more from .{2,40}|read (?:next|also)|recommended.{0,20}|editor'?s picks
verwandte beiträge|das könnte .{2,40}|meistgelesen|mehr von .{2,40}|lesen sie auch|auch interessant|weitere (?:beiträge|artikel)
también te puede interesar|lo más leído|más de .{2,40}|notas relacionadas|te recomendamos|lee también
leia também|mais lidas|mais de .{2,40}|notícias relacionadas|você também pode .{2,40}|recomendadas
"""


_SPECIAL = re.compile(r"[\\.\[\](){}?*+$^|]")


def _expand(cue: str) -> list[str]:
    """A cue without its groups of literal alternatives: a(?:b|c)d gives abd and acd."""
    m = re.search(r"\(\?:([^()\[\]\\.*+?{}$]*)\)(\?)?", cue)
    if not m:
        return [cue]
    return [x for w in (*m[1].split("|"), *([""] if m[2] else [])) for x in _expand(cue[: m.start()] + w + cue[m.end() :])]


def _split(block: str) -> list[str]:
    """The cues of a block; | within brackets or groups does not part them."""
    cues = []
    for line in block.strip().split("\n"):
        depth, last = 0, 0
        for i, c in enumerate(line + "|"):
            depth += (c in "([") - (c in ")]")
            if c == "|" and depth == 0:
                cues += _expand(line[last:i])
                last = i + 1
    return cues


def _matcher(block: str) -> tuple[tuple[str, ...], re.Pattern]:
    """Literal cues as strings, for tests without regular expressions, and one pattern of the rest."""
    cues = _split(block)
    literal = tuple(dict.fromkeys(c for c in cues if not _SPECIAL.search(c)))
    return literal, re.compile("|".join(f"(?:{c})" for c in cues if _SPECIAL.search(c)))


_START_WORDS, _START = _matcher(START_CUES)
_INNER_WORDS, _INNER = _matcher(INNER_CUES)
_HEADING_WORDS, _HEADING = _matcher(LIST_HEADINGS)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->")
_COMMENT = re.compile(r"(?:@\w{1,20}|(?:用户|网友|读者|游客|匿名)\w{1,20}|(?:user|reader|guest|leser|lector|leitor|usuario|usuário) ?\w{1,20}) ?: ?\S")
_TAGS = re.compile(r"(?:#[^\s#]+[\s,、]*){2,}|(?:\[[^\[\]]{1,40}\]\s*){2,}|(?:标签|关键词|关键字|话题|tags?|keywords|topics|etiquetas|temas|schlagwörter|themen|palavras-chave|marcadores) ?[:/] ?.*")
_LINK = re.compile(r"(?:>>|»|▸|→|·(?!\s*·))\s*\S|(?:延伸阅读|相关阅读|推荐阅读|点击查看|上一篇|下一篇|前文|read more|read also|see also|lesen sie auch|lee también|leia também|mehr dazu) ?:? ?[《\"“]?\S")
_CRUMB = re.compile(r" ?[>»/|] ?")
_STAMP = re.compile(r"\W*(?:\d{4}[-./年]\d{1,2}[-./月]\d{1,2}日?|\d{1,2}[-./]\d{1,2}[-./]\d{4})\W*(?:\d{1,2}:\d{2})?.{0,40}$")
_BULLET = re.compile(r"(?:[•*▪◦‣-]\s*|\(?\d{1,2}[、)）.]\s*)(?=\S)")
_NUMBERED_LINK = re.compile(r"\d{1,2}\.\s")
_PARTS = re.compile(r"　+|\s{2,}|\s*[|/>»·丨]\s*")
_ENDS, _CLOSERS = frozenset("。!?…；;.”\"」』’:！？"), "'”\"」』)）"
_CLAUSE = re.compile(r"[。!?；;，,]|\. ")
_NOT_CJK = re.compile(r"[^㐀-鿿豈-﫿]+")
_QUOTE = ("“", '"', "「", "『", "«", "„")

#: Forms of lines: running text, list item, quotation, unended line, short words beside one another, link, tags and the like.
TEXT, ITEM, QUOTE, SHORT, MENU, LINK, PART, BLANK = range(8)
#: Lines of a window.
WINDOW = 3
#: Columns (CJK characters count 2) that a window must hold for a surge, that a line must weigh to be of the
#: article's core, and to be its edge if it is no item or quotation.
SURGE, CORE, EDGE = 150, 100, 80
#: Lines that may stand between the core and an item, quotation or sentence at its edge.
GAP = 1
#: Share of its length that an unended line weighs; share left to a line with a cue, and columns a cue takes off at most.
UNENDED, FAINT, NOTICE = 0.3, 0.2, 120


def plain(line: str) -> str:
    """The line without markup, in folded width, with single spaces."""
    if "<" in line:
        line = _TAG.sub(" ", line)
    return " ".join((line if line.isascii() else unicodedata.normalize("NFKC", line)).split())


def columns(text: str) -> int:
    """Length with CJK characters counted twice, so that windows compare across scripts."""
    return len(text) if text.isascii() else len(text) + len(_NOT_CJK.sub("", text))


def _form(raw: str, text: str, width: int) -> int:
    """Form of a line; nothing but signs of its make-up counts, no phrase but labels of tags, links and comments."""
    if not text:
        return BLANK
    ended = _ended(text)
    if ended and width >= NOTICE + SURGE:
        return TEXT  # as long as a paragraph, and ended
    low = text.lower()
    if _COMMENT.match(low) or _TAGS.fullmatch(low) or text.endswith(("…", "...")) and _is_crumbs(text):
        return PART
    if _BULLET.match(text):
        return LINK if _NUMBERED_LINK.match(text) and not ended else ITEM
    if text[0] in _QUOTE and ended:
        return QUOTE
    if _LINK.match(low):
        return LINK
    if _STAMP.match(text):
        return PART
    if not ended and _is_menu(raw, text):
        return MENU
    return TEXT if ended or width > EDGE and _CLAUSE.search(text) and not _is_headline(text) else SHORT


def _is_headline(text: str) -> bool:
    """An unended line whose clause marks part it in no more than three."""
    return len(_CLAUSE.findall(text)) <= 2


def _is_crumbs(text: str) -> bool:
    """Names of pages above one another, the last cut off."""
    parts = _CRUMB.split(text)
    return len(parts) > 1 and all(0 < len(p) <= 60 for p in parts)


def _ended(text: str) -> bool:
    """Whether the line ends as a sentence does."""
    return text[-1] in _ENDS or (text.rstrip(_CLOSERS) or " ")[-1] in _ENDS


def _is_menu(raw: str, text: str) -> bool:
    """Short words beside one another, or one alone."""
    if len(text.split()) <= 3 and columns(text) <= 24 and ":" not in text and not any(c.isdigit() for c in text):
        return True
    parts = [p for p in _PARTS.split(raw.strip()) if p.strip()]
    return len(parts) >= 2 and all(columns(p) <= 30 for p in parts) and (len(parts) >= 3 or columns(text) <= 40)


def is_list_heading(text: str) -> bool:
    low = text.lower()
    return low.rstrip(":") in _HEADING_WORDS or _HEADING.fullmatch(low) is not None


def has_cue(text: str, form: int) -> bool:
    """Whether a cue phrase stands at the line's start, or one of the inner ones anywhere (list items: inner ones only)."""
    low = text.lower()
    if any(w in low for w in _INNER_WORDS) or _INNER.search(low):
        return True
    return form in (TEXT, SHORT, MENU) and (low.startswith(_START_WORDS) or _START.match(low) is not None or is_list_heading(text))


@lru_cache(maxsize=200_000)
def read_line(raw: str) -> tuple[str, int, int, bool]:
    """Plain form, columns, form of one line as it came, and whether it has a cue."""
    text = plain(raw)
    width = columns(text)
    form = _form(raw, text, width)
    # beyond this length a line weighs what a surge takes even with a cue
    return text, width, form, width < NOTICE + SURGE and form in (TEXT, ITEM, SHORT, MENU) and has_cue(text, form)


def read_body(body: str) -> list[tuple[str, int, int, bool]]:
    """read_line of each line; long lines, which do not come twice, stay out of the cache."""
    return [read_line(r) if len(r) <= 400 else read_line.__wrapped__(r) for r in body.split("\n")]


def weight(width: int, form: int, cue: bool) -> float:
    """Columns of running text that a line counts for."""
    if form in (MENU, LINK, PART, BLANK):
        return 0.0
    w = width * UNENDED if form == SHORT else float(width)
    return max(w * FAINT, w - NOTICE) if cue else w


def article_lines(lines: list[tuple[str, int, int, bool]], cues: bool = True, windows: bool = True) -> list[bool]:
    """Which lines of a body (read_body) belong to the article.

    ``cues`` and ``windows`` may be turned off to see what each of them does: without windows every line that
    weighs anything is the article's.
    """
    shown = [i for i, x in enumerate(lines) if x[2] != BLANK]
    n = len(shown)
    forms = [lines[i][2] for i in shown]
    cued = [cues and lines[i][3] for i in shown]
    own = [weight(lines[i][1], f, c) for i, f, c in zip(shown, forms, cued)]
    inside = [False] * len(lines)
    if not windows:
        for j in range(n):
            inside[shown[j]] = own[j] > 0 and not (cued[j] and own[j] < EDGE)
        return inside
    sums = [sum(own[max(0, j - WINDOW // 2) : j + WINDOW // 2 + 1]) for j in range(n)]
    surge = min(SURGE, 0.6 * max(sums, default=0.0))
    steady = [f in (ITEM, QUOTE) and not c for f, c in zip(forms, cued)]
    core = [j for j in range(n) if sums[j] >= surge and (own[j] >= CORE or steady[j])]
    core = core or [j for j in range(n) if own[j] > 0 and forms[j] != SHORT and not cued[j]]
    if not core:
        return inside
    first = _edge(core[0], -1, forms, own, cued, steady)
    last = _edge(core[-1], 1, forms, own, cued, steady)
    for j in range(first, last + 1):
        if forms[j] in (PART, LINK) or cued[j] and own[j] < EDGE:
            continue  # a dip within the article
        if forms[j] == MENU and not (first < j < last and all(steady[k] or own[k] >= EDGE for k in (j - 1, j + 1))):
            continue  # words alone are a sub-heading only between two blocks of text
        inside[shown[j]] = True
    return inside


def _edge(at: int, step: int, forms: list[int], own: list[float], cued: list[bool], steady: list[bool]) -> int:
    """Where the article ends on one side of its core: items, quotations and sentences go on with it, and a
    sub-heading that has text on its other side."""
    j, gap = at + step, 0
    while 0 <= j < len(forms) and gap <= GAP:
        if steady[j] or forms[j] == TEXT and own[j] >= EDGE:
            at, gap = j, 0
        elif forms[j] == SHORT and not cued[j] and gap == 0 and 0 <= j + step < len(forms) and own[j + step] >= EDGE:
            at = j
        else:
            gap += 1
        j += step
    return at
