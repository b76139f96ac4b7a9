"""Cue phrases of page furniture, errors and fillers in the eight corpus languages.

Phrases are lower case with every digit run written as ``0`` and single spaces. ``^`` stands for the
start of a line and ``$`` for its end. They are short cues, not whole notices: a cue only makes a line, or the
sentence it stands in, count as a link for the scores, whatever names the line carries.
"""

LANGS = ("de", "en", "es", "fr", "it", "pt", "ru", "zh")

#: Lines about the page rather than the story: time and author lines, share and comment prompts, consent and rights notices.
FURNITURE = {
    "en": (
        "^by going on you agree", "^reporting by ", "^published 0:0", "^updated at 0", "^updated 0:0", "0 min read", "^0 shares$", "^0 share$", "^0 comments$", "^0 comment$",
        "^share this ", "^share tweet", "^copy link", "^save for later", "^follow us ", "^join the conversation", "^sign up for our", "no spam, unsubscribe",
        "^download our app", "^listen to this article", "^enjoying this article", "support independent reporting", "^article continues below", "^scroll to read on", "^advertisement$", "^sponsored content", "^sponsored$",
        "^this site uses cookies", "this site uses cookies", "values your privacy", "^before you continue:",
        "^©", "^about us |",
        " correspondent$",
    ),
    "fr": (
        "^publié à 0", "^mis à jour à 0", "lecture 0 min$", "^0 partages$", "^0 partage$", "^0 commentaires$", "^0 commentaire$", "^partager cet article", "^partager tweeter", "^partager envoyer", "^copier le lien", "^lire plus tard", "^suivez-nous",
        "^réagir à cet article", "^connectez-vous pour", "^inscrivez-vous à", "^télécharge", "^écouter l'article", "^cet article vous a plu", "^la suite après cette annonce", "^publicité$", "^contenu sponsorisé",
        "^nous utilisons des cookies", "partenaires enregistrent", "^avec votre accord,", "^qui sommes-nous |", "^toute reproduction",
        "^par 0", ", correspondance pour",
    ),
    "es": (
        "^publicado 0", "^actualizado a las", "0 veces compartido$", "^0 comentarios$", "^0 comentario$", "^compartir esta", "^compartir enviar", "^copiar enlace", "^guardar para después", "^síganos", "^síguenos", "^únase a la", "^inicie sesión para",
        "^apúntese a", "^reciba cada mañana", "^descargue", "^descarga", "^escuchar el artículo", "¿le gustó este artículo", "^sigue leyendo tras", "^publicidad$", "^contenido patrocinado", "^usamos cookies", "socios guardan información", "^con su permiso,",
        "^quiénes somos |", "^prohibida la reproducción", ", corresponsalía de",
    ),
    "de": (
        "^veröffentlicht 0", "^aktualisiert um", "lesezeit 0 min", "^0 mal geteilt$", "^0-mal geteilt$", "^0 kommentare$", "^0 kommentar$", "^artikel teilen", "^teilen ", "^link kopieren", "^für später merken", "^folgen sie uns", "^diskutieren sie mit", "^zum kommentieren", "^newsletter bestellen",
        "^artikel anhören", "^weiterlesen nach", "^anzeige$", "^gesponserter", "^gesponsert$", "^bezahlter inhalt", "^wir verwenden cookies", "partner speichern informationen", "^über uns |", "^nachdruck",
        ", korrespondenz für", " schreibt seit 0 ", "^laden sie",
    ),
    "it": (
        "^pubblicato ", "^aggiornato alle", "lettura 0 min", "^0 condivisioni$", "^0 condivisione$", "^0 commenti$", "^0 commento$", "^condividi ", "^copia il link", "^salva per dopo", "^leggi più tardi", "^seguici", "^partecipa alla", "^di' la tua", "^accedi per commentare", "^iscriviti alla",
        "^ricevi ogni mattina", "^scarica ", "^ascolta l'articolo", "^ti è piaciuto", "^l'articolo continua", "^pubblicità$", "^contenuto sponsorizzato", "^usiamo i cookie", "partner conservano informazioni", "piccoli file", "^chi siamo |", "^riproduzione ", "^vietata la riproduzione",
        "^vi è piaciuto", "^le è piaciuto",
    ),
    "pt": (
        "^publicado às", "^publicado 0", "^atualizado às", "^0 partilhas$", "^0 partilha$", "^0 comentários$", "^0 comentário$", "^partilhar ", "^copiar ligação", "^ler mais tarde", "^siga-nos", "^participe ", "^junte-se à", "^inicie sessão para", "^assine a nossa", "^descarregue",
        "^ouvir o artigo", "^gostou d", "^continua depois do anúncio", "^publicidade$", "^conteúdo patrocinado", "^usamos cookies", "parceiros guardam informações", "pequenos ficheiros", "^quem somos |", "^proibida a reprodução",
    ),
    "ru": (
        "^опубликовано", "^обновлено в", "чтение: 0", "^поделились: 0", "^комментариев: 0", "^поделиться", "^скопировать ссылку", "^сохранить на потом", "^отложить", "^подпишитесь", "^подписаться на рассылку", "^обсудить", "^присоединяйтесь", "^войдите, чтобы", "^скачайте", "^слушать статью", "^понравилась статья", "^понравился ",
        "^продолжение после рекламы", "^реклама$", "^на правах рекламы", "^мы используем файлы cookie", "партнёров хранят сведения", "^с вашего согласия", "^о нас |", "^перепечатка", "^воспроизведение", "без письменного разрешения", "^мнение автора может", "^текст впервые", "^этот текст впервые", ", корреспондент ", "^автор: ", " пишет для ", "все права защищены",
    ),
    "zh": (
        "^发布于", "^更新于", "阅读需", "次分享$", "条评论$", "^分享本文", "^分享 ", "^复制链接", "^稍后阅读", "^保存", "^关注我们", "^参与讨论", "^加入讨论", "^登录后发表评论", "^订阅我们的通讯", "^每天早晨在您的邮箱", "^下载", "^收听本文", "^喜欢这篇", "广告之后继续阅读", "^广告$", "^赞助内容", "小型文本文件来统计", "家合作伙伴", "^为了继续", "在您的浏览器中保存", "^关于我们 |", "版权所有", "不得转载", "^本文只代表作者观点", "^本文首发于", "^本报记者", "^记者 ", "的立场。$",
    ),
}

#: Labels over lists of other articles.
LABELS = {
    "en": ("more from ", "most read", "related stories", "you may also like", "editor's picks", "read also", "read more"),
    "fr": ("les plus lus", "la sélection de ", "sur le même sujet", "à lire aussi", "lire aussi", "plus de "),
    "es": ("lo más leído", "la selección de ", "más sobre este tema", "le puede interesar", "más de ", "lea también"),
    "de": ("mehr zum thema", "empfehlungen von ", "lesen sie auch", "meistgelesen", "mehr von "),
    "it": ("i più letti", "leggi anche", "sullo stesso tema", "la selezione di ", "scelti da ", "altro da "),
    "pt": ("leia também", "mais lidas", "mais sobre ", "sobre o mesmo tema", "a seleção de ", "a escolha de ", "mais de "),
    "ru": ("самое читаемое", "читайте также", "ещё по теме", "выбор ", "ещё от "),
    "zh": ("相关阅读", "阅读更多", "最多阅读", "热门", "编辑推荐", "推荐"),
}

#: Words of menus; a line of them only is a menu.
MENU = {
    "en": "home|world|politics|business|opinion|culture|sport|weather|video|podcasts|archive|search|sign in|my account|subscribe|about us|contact|careers|imprint|privacy notice|terms of use",
    "fr": "accueil|monde|politique|économie|débats|culture|sports|sport|météo|vidéos|archives|recherche|se connecter|s'abonner|qui sommes-nous|contact|mentions légales|confidentialité|conditions d'utilisation|mon compte",
    "es": "inicio|mundo|política|economía|opinión|cultura|deportes|el tiempo|vídeos|hemeroteca|buscar|iniciar sesión|suscríbete|quiénes somos|contacto|aviso legal|privacidad|condiciones de uso|mi cuenta",
    "de": "startseite|welt|politik|wirtschaft|meinung|kultur|sport|wetter|mediathek|archiv|suche|anmelden|abo|über uns|kontakt|impressum|datenschutz|nutzungsbedingungen|mein konto",
    "it": "prima pagina|mondo|politica|economia|opinioni|cultura|sport|meteo|video|archivio|cerca|accedi|abbonati|chi siamo|contatti|note legali|privacy|condizioni d'uso|il mio conto",
    "pt": "início|mundo|política|economia|opinião|cultura|desporto|tempo|vídeos|arquivo|pesquisar|entrar|assinar|quem somos|contactos|ficha técnica|privacidade|condições de utilização|termos de uso|a minha conta",
    "ru": "главная|мир|политика|экономика|мнения|культура|спорт|погода|видео|архив|поиск|войти|подписка|о нас|контакты|выходные данные|конфиденциальность|условия использования|мой кабинет",
    "zh": "首页|国际|政治|财经|评论|文化|体育|天气|视频|专题|搜索|登录|订阅|关于我们|联系方式|隐私声明|使用条款|时政|经济|世界|观点|档案|我的账户",
}

#: Author lines that hold nothing but a name after the word.
BYLINE = {"en": "by ", "fr": "par ", "es": "por ", "de": "von ", "it": "di ", "pt": "por ", "ru": "автор: ", "zh": "记者"}

#: Frequent function words; real prose of a language has some of them in every few words.
FUNCTION_WORDS = {
    "en": "the of a an and to in is was said that for with on it at by who after before no not what as or from",
    "fr": "le la les des une un de du et à en que qui est sont pour dans sur au aux par ont a ne pas si lors",
    "es": "el la los las de del un una y en que es se por con para al su sin lo no más",
    "de": "der die das den dem des ein eine einen und in im zu mit von für auf ist sind nicht sich wer aus nach uns hat",
    "it": "il lo la i gli le un una di del della dei e in che è si per con non su al alla ci ha",
    "pt": "o a os as de do da dos das um uma e em no na que se por com para ao não mais",
    "ru": "и в на не что по с за из от для без к о у это как около потому хотя так",
}

#: Messages of servers, scripts and robot checks, in any position of a line.
ERRORS = (
    "not found", "404", "error 0", "erreur 0", "fehler 0", "errore 0", "erro 0", "ошибка 0", "错误0", "http 0", "forbidden", "access denied", "accès refusé", "acceso denegado", "zugriff verweigert", "accesso negato", "acesso negado", "доступ запрещён", "доступ закрыт", "拒绝访问", "访问被拒绝",
    "bad request", "bad gateway", "time-out", "timed out", "too many requests", "service unavailable", "not available at the moment", "internal server error", "traceback", "typeerror", "referenceerror", "exception in ", "stack trace", "database connection", "at edge-", "secure connection failed",
    "^gone$", "^0 gone$", "^conflict$", "unavailable for legal reasons", "request timeout", "method not allowed", "not acceptable", "payment required", "not implemented", "{\"error\"", "#0-0)", "<hr><center>",
    "nicht erreichbar", "the server answered", "le serveur a répondu", "el servidor respondió", "der server antwortete", "il server ha risposto", "o servidor respondeu", "сервер ответил", "服务器返回",
    "javascript", "scripts enabled", "blocks scripts", "scripts must be allowed", "enable scripts", "blockiert skripte", "bloque les scripts", "bloquea los scripts", "blocca gli script", "bloqueia os scripts", "блокирует скрипты", "скрипты", "脚本", "not a robot", "robot", "roboter", "робот", "机器人", "captcha",
    "something went wrong", "unauthorized", "unauthorised", "server error", "algo salió mal", "algo ha salido mal", "une erreur est survenue", "ist etwas schiefgelaufen", "qualcosa è andato storto", "algo correu mal", "что-то пошло не так", "出了问题", "non disponibile", "no está disponible", "indisponible", "nicht verfügbar", "não está disponível", "indisponível", "недоступ", "不可用", "请稍后再试",
    "has been taken down", "link has run out", "n'est plus en ligne", "ya no está disponible", "nicht mehr verfügbar", "nicht mehr online", "non è più disponibile", "non è più online", "já não está disponível", "удалена", "больше недоступн", "已删除", "已被移除", "找不到", "does not exist", "no longer exists", "page introuvable", "página no encontrada", "página não encontrada", "pagina non trovata", "seite nicht gefunden", "страница не найдена", "页面不存在",
)

#: Filler and undefined values that stand where content should.
FILLERS = (
    "test test", "insertar ", "titular de ejemplo", "sustituya este párrafo", "escriba aquí su texto", "substitua este parágrafo", "o seu texto aqui", "inserir ", "inserire ", "insérer ", "votre texte ici", "remplacez ce paragraphe", "ihr text hier", "hier steht ihr text", "ersetzen sie diesen absatz", "einfügen", "il tuo testo qui", "sostituisci questo paragrafo", "titolo di esempio", "titre d'exemple", "exemple de titre", "beispielüberschrift", "beispieltitel", "título de exemplo", "ваш текст", "замените этот абзац", "вставить ", "вставьте", "пример заголовка", "образец заголовка", "在此输入", "此处插入", "替换此段", "示例标题", "插入",
    "请在此处输入", "替换本段", "à rédiger", "chapeau de 0 signes", "0 zeichen ", "0 battute", "0 знаков", "0字符", "de 0 caracteres",
    "lorem ipsum", "your text goes here", "replace this paragraph", "sample headline", "layout purposes", "body copy to follow", "copy to follow", "placeholder text", "dummy text", "text to come", "insert intro", "insert headline", "insert body", "[object object]", "undefined undefined", "null - null", "texto de relleno", "blindtext", "texte de remplissage", "testo segnaposto", "texto de preenchimento", "текст-заполнитель", "占位文字",
)

#: Of the messages, those no article quotes: beside one of them a lone sentence is part of the message.
MACHINE = ("traceback: ", "typeerror: ", "referenceerror: ", "at edge-0", "<hr><center>", "{\"error\"", "gateway time-out after", "#0-0)")
