"""Words by class, phrases and prior weights of the abuse scorer, as plain text.

Words are written without accents, as the scorer folds texts; entries of several words are phrases, matched
word by word.  A word belongs to the first class that lists it.  Which contexts make a word abuse
is no list of sentences: it is learned from reviewed documents, starting from PRIORS.
"""

#: Class -> words; in order of precedence.  Languages: English, German, French, Spanish, Italian, Portuguese, Polish, Russian.
CLASSES = {
    # insulting nouns
    "INS": """
        idiot idiots moron morons imbecile imbeciles cretin cretins halfwit halfwits dumbass dumbasses asshole assholes arsehole arseholes
        bitch bitches bastard bastards dickhead dickheads prick pricks scumbag scumbags loser losers clown clowns swine
        shithead shitheads fuckface fucktard fuckwit motherfucker motherfuckers fucker fuckers cunt cunts twat twats wanker wankers tosser tossers slut sluts whore whores hoe
        retard retards nitwit nitwits dimwit dimwits simpleton jackass jerk jerks numbskull dipshit douchebag douche bellend knobhead
        crybaby weasel degenerate degenerates buffoon imbecil dunce ignoramus dolt dumbo airhead coward cowards pervert perverts creep creeps
        arschloch arschlocher vollidiot vollidioten idioten penner wichser trottel dummkopf schwachkopf hurensohn hure schlampe fotze miststuck drecksack
        spast spasti spasten missgeburt schwein dreckskerl depp deppen volltrottel arsch versager dreckschwein flachzange lappen
        connard connards connasse salaud salope abruti abrutis batard encule enculer ordure pute cretine debile idiote bouffon minable
        gilipollas cabron cabrones pendejo pendeja puta puto zorra capullo cabrona idiota idiotas tarado malnacido estupido estupida inutil subnormal
        imbecille stronzo stronza coglione deficiente cretino puttana otario babaca arrombado vadia burro
        kretyn kretyni debil debile dupek skurwysyn kurwa suka szmata palant gnoj frajer matol cham idioci
        идиот идиоты дурак дура придурок тупица кретин мудак сволочь тварь ублюдок сука урод мразь дебил шлюха козел подонок
    """,
    # words for what is worthless or vile, of people
    "VILE": """
        plague animals animal cockroach cockroaches vermin parasites parasite rats rat scum filth disease subhuman subhumans pest pests trash garbage dirt apes ape monkeys monkey
        maggot maggots leech leeches savages savage pigs pig dogs snake snakes inferior waste dung
        ungeziefer pack gesindel abschaum parasiten ratten dreck mull tiere untermenschen
        vermine racaille nuisibles merde dechets rats chiens
        plaga parasitos escoria ratas basura mierda feccia merda lixo
        robactwo szumowiny pasozyty smieci holota bydlo zwierzeta
        отбросы мусор говно дерьмо паразиты крысы скот
    """,
    # slurs: words that demean a group by themselves
    "SLUR": "nigger niggers nigga faggot faggots fag fags kike kikes spic spics chink chinks gook gooks paki pakis wetback wetbacks tranny trannies raghead ragheads kanake kanaken neger schwuchtel bougnoule bougnoules negre youpin maricon maricones sudaca sudacas pedal pedaly ciapaty ciapaci ciota жид жиды чурка чурки пидор пидоры",
    # demeaning adjectives and intensifiers
    "ADJ": """
        stupid worthless useless lazy filthy disgusting miserable spineless brainless goddamn pathetic dumb braindead clueless ignorant
        ugly rotten idiotic moronic stinking lousy incompetent damn bloody dirty repulsive gutless talentless hopeless fat retarded stupider dumber
        damliche damlicher dammlicher dummer dumme dummes dumm blod fauler faule verdammter verdammte verdammtes verfluchter blode bloder widerlicher widerlich mieser dreckiger hasslicher wertlos
        sale pauvre putain stupide foutu miserable nul nulle moche degoutant degueulasse con conne bete
        pobre maldito maldita asqueroso asquerosa patetico tonto tonta feo fea
        stupido stupida schifoso inutile brutto burra nojento
        pieprzony pieprzona jebany jebana glupi glupia glupie zasrany cholerny tepy zalosny brzydki durny
        тупой тупая глупый жалкий грязный мерзкий уродливый бесполезный
    """,
    # words that tell somebody to go away, be silent or die
    "CURSE": "stfu gtfo kys verpiss verrecke stirb fresse schnauze gueule jodete callate muerete vaffanculo spierdalaj wypierdalaj zdechnij umrzyj zamknij заткнись сдохни нахуй",
    # swearing, by itself at nobody
    "SWEAR": """
        fuck fucks fucking fucked fucken shit shits shitty bullshit ass arse piss pissed crap damned hell screw
        scheisse scheiss kacke fick fickt klappe foutre nique niquer ferme casse creve
        joder mierda chinga verga cono vete cazzo zitto foda fodase cala
        pierdol pierdolony dupe dupa jebac ryj morde блять хуй хер пошел
    """,
    # groups of people
    "GRP": """
        women woman girls females gays gay lesbians lesbian homosexuals transgender immigrants immigrant refugees refugee foreigners foreigner muslims muslim jews jew blacks christians hindus
        believers atheists disabled cripples villagers migrants migrant natives gypsies roma asians africans arabs mexicans chinese indians poles turks germans russians blondes southerners northerners easterners
        frauen auslander fluchtlinge schwule zugezogene juden muslime behinderte turken polen neger
        femmes etrangers immigres refugies juifs musulmans homosexuels arabes noirs handicapes
        mujeres inmigrantes extranjeros refugiados judios musulmanes negros gitanos
        immigrati stranieri ebrei mulheres imigrantes judeus
        kobiety obcy uchodzcy imigranci cudzoziemcy zydzi geje murzyni
        женщины бабы евреи мигранты геи негры
    """,
    # explicit sexual words
    "SEX": """
        cock cocks dick dicks pussy pussies tits titties titty boobs boob nipples nipple penis vagina clit cum dildo blowjob blowjobs handjob handjobs horny porn porno xxx
        nudes orgasm masturbate masturbating anal erection boner gangbang milf threesome deepthroat jerked jerking wank wanking nymphomaniac
        titten schwanz muschi ficken ficke geil geile mose nackt
        nichons chatte bite baiser sucer suce seins nue
        tetas polla follarte follar culo desnuda coger chupame chupamela
        tette fica scopare buceta peitos foder
        cycki cipa kutas ruchac pieprzyc nago
        сиськи член трахнуть трахать минет
    """,
    # words that are sexual in company
    "BODYSEX": "naked nude butt thighs thigh moaned moan moaning underwear bra panties lingerie lips strip undress undressed sexy kinky bed suck sucking lick licking ride cam webcam escort sweating touch bend spread hard wet unzipped cleavage hot brust popo hintern ausziehen zieh lutsch fesses cuisses deshabille ensename desnudate rozbierz",
    # violence and death
    "KILL": """
        kill killing killed murder die dying dead death hang hurt shoot stab strangle burn drown beat rape break smash crush rip cut destroy sterilised sterilized gas gassed exterminate lynch execute
        slit punch choke bleed rot perish suffer cripple castrate shut cripple vanish disappear regret push jump
        umbringen toten tote sterben verrecken abkratzen krepieren erschiessen verbrennen aufhangen abstechen vergasen schlagen
        tuer mourir creve crever bruler noyer pendre frapper egorger buter
        matar morir mueras quemar ahorcar golpear pegar colgar
        ammazzare morire muori uccidere ammazzo morrer
        zabic zabije zdechnac umrzec spalic powiesic pobic utopic
        убью убить умри сдохнуть сжечь повесить
    """,
    "WPN": "knife knives hammer gun guns axe rifle shotgun pistol bomb rope fist fists bat bullet bullets machete noose messer pistole axt gewehr couteau fusil cuchillo pistola noz siekiera нож пистолет",
    "BODY": "face faces hands hand fingers finger knees knee teeth legs leg arms arm neck bones bone head skull jaw throat kopf halse knochen zahne gueules dents jambes cara dientes piernas zeby nogi głowe",
    # second person
    "YOU": "you your yours yourself yourselves youre youve youll ur u du dich dir dein deine deinen deiner deinem euch eure ihr tu toi te ton ta tes vous votre vos ti tus usted ustedes vosotros tuo tua voi voce seu ty ciebie cie ci tobie twoj twoja twoje wy wam ты тебя тебе твой твоя вы вас вам",
    # third person, of groups
    "THEM": "they them their theirs themselves those these people person folks sie ihnen denen leute ils elles leur eux gens ellos ellas gente loro oni ich tych ludzie они их им люди",
    # first person
    "SELF": "i im ive id ill me my myself mine we our us mir mich mein meine meinen wir je moi mon ma mes nous yo mi mis nosotros io mio eu meu ja moj moja moje mnie my я меня мне мой",
    # talk about abuse, which isn't abuse
    "TALK": "insult insults insulting insulted moderator moderators moderation moderate hateful abusive abuse offensive slur slurs word words term terms removed deleted policy lexicon dataset detector classifier filter labelled annotate linguistics etymology banned report reported reports forbidden",
    # things, not people
    "TECH": "process processes job jobs worker workers thread threads node nodes server servers queue queues container pod pods cluster daemon kernel task tasks run runs script scripts session instance service branch loop signal program pipeline command memory cpu gpu disk log logs file files token cache connection valve pipe stopcock wrench drill bit screw tap engine battery screen terminal variable parameter parameters function module package build circuit circuits qubit qubits optimizer ansatz gradient simulation simulator sweep energy schema table prozess dienst rechner lauf skript fil processus tache serveur proceso tarea servidor proces zadanie serwer процесс сервер",
    "LINK": "are is be am were was bist seid sind ist est es etes sont eres sois son sei siete jestes jestescie sa",
    "WANT": "want wants wanna will gonna going shall would should could ought must need let lets hope hoping wish pray deserve deserves werde werden will soll sollen sollte sollten hoffe je vais va veux esperons devrait voy vas quiero ojala deberian deberias vado voglio spero vou quero chce bede niech powinni powinienes хочу буду надо",
    "HATE": "hate hates despise detest loathe disgust disgusts sicken hasse verachte hais deteste odio detesto odeio nienawidze gardze ненавижу презираю",
    "OUT": "out raus dehors hors fuera fora fuori wynocha precz kitchen kuche cuisine cocina kuchni garow вон",
    "HOME": "live lives sleep house home address street family mother father parents children kids sister wife car park door wohnst haus familie mutter kinder habites maison famille mere vives casa familia madre mieszkasz dom rodzina matka живешь дом семья мать",
    "BRAIN": "brain brains iq smart smarter clever wit human humans nature born kind skin colour color race religion village hirn menschen cerveau humains peau cerebro piel mozg ludzmi мозг",
    "NICE": "thanks thank thx congratulations congrats great please welcome sorry love danke bitte merci gracias dzieki спасибо",
}

#: Classes around whose words a window is read.
ANCHORS = "INS VILE SLUR ADJ CURSE SWEAR GRP SEX BODYSEX KILL WPN BODY YOU THEM HATE OUT HOME BRAIN TERM".split()

#: Phrases that are abuse by themselves, each with what it adds.
PHRASES = """
3.5 fuck you
3.5 screw you
3.5 fuck off
3.0 piss off
3.0 shut up
2.0 shut your
3.0 eat shit
3.0 kill yourself
3.5 drop dead
3.0 go hell
3.0 kiss my
3.0 suck my
3.0 son bitch
3.0 piece shit
2.5 waste space
2.5 know where
2.5 get lost
3.0 jerk off
3.0 jerked off
3.0 fick dich
3.0 halt maul
3.0 halt klappe
3.0 bring dich
3.0 va foutre
3.0 nique ta
3.0 casse toi
3.0 hijo puta
3.0 vete mierda
3.0 te matar
2.5 por culo
3.0 te tuer
3.0 w dupe
3.0 zabije cie
3.0 пошел нахуй
"""

#: Abuse in Japanese, Chinese and Korean script, read letter by letter.
CJK = """
死ね 殺す 殺してやる くたばれ 消えろ クソ野郎 くそ野郎 くそったれ 馬鹿野郎 バカ野郎 ばかやろう 馬鹿 バカ アホ ブス デブ キチガイ クズ ゴミ野郎 カス うざい きもい 黙れ ちんこ まんこ おっぱい 売女 変態 ヤリマン
去死 傻逼 傻屄 傻子 白痴 蠢货 蠢猪 笨蛋 操你 肏你 你妈 他妈的 狗娘养 王八蛋 混蛋 贱人 婊子 废物 垃圾 杀了你 弄死你 滚出去 滚开 闭嘴 猪狗 脑残 畜生 胸部 奶子 鸡巴 做爱
죽어 병신 씨발 개새끼 꺼져
"""
CJK_YOU = "お前 おまえ てめえ 貴様 あんた あなた 君 你 你们 您 너 당신"
CJK_GROUPS = "女 女性 外国人 移民 難民 难民 黑人 犹太人 同性恋 障害者 残疾人 老人"

#: Prior weights of a window: "CLASS weight" for its anchor, "CLASS other side weight" for a word of the class ``other``
#: in the window: ``<`` and ``>`` within two words to the left or right, ``<<`` and ``>>`` beyond, ``*`` anywhere; COMMA is a comma, LAST and FIRST say that the anchor ends or begins its sentence.
#: Labels move them; without labels they are the model.
BIAS = -3.0
PRIORS = """
INS 1.4
VILE 0.4
SLUR 3.6
SWEAR 1.0
CURSE 3.1
ADJ 0.3
SEX 1.6
BODYSEX 0.4
TERM 3.4
HATE 0.5
INS YOU * 2.0
INS COMMA < 0.9
INS LAST 0.6
INS FIRST 0.5
INS ADJ < 1.8
INS ADJ > 0.6
INS SWEAR * 0.8
INS INS * 0.6
INS SELF < -2.2
INS SELF << -0.8
INS TALK * -2.0
INS TECH * -0.6
INS GRP * 1.6
INS THEM * 0.8
VILE YOU * 2.0
VILE ADJ < 1.4
VILE GRP << 2.8
VILE GRP < 2.8
VILE THEM * 1.0
VILE TECH * -1.5
VILE SWEAR * 0.6
SLUR TALK * -3.0
SWEAR YOU > 2.0
SWEAR WANT < 1.0
CURSE TALK * -1.5
SWEAR YOU < 0.8
SWEAR INS * 1.0
SWEAR NICE * -1.5
SWEAR TALK * -1.5
ADJ YOU < 1.8
ADJ YOU > 1.2
ADJ GRP * 1.8
ADJ THEM < 1.0
ADJ VILE > 1.0
ADJ TECH * -1.2
ADJ SELF < -0.8
ADJ TALK * -1.0
GRP HATE * 2.6
GRP KILL * 2.0
GRP OUT * 2.2
GRP VILE * 2.0
GRP BRAIN * 1.2
GRP TALK * -2.0
GRP SLUR * 1.0
GRP ADJ > 0.6
SEX YOU * 1.6
SEX SELF * 1.0
SEX WANT * 0.8
SEX SEX * 1.2
SEX BODYSEX * 1.0
SEX TECH * -2.2
SEX TALK * -2.0
BODYSEX YOU * 1.2
BODYSEX BODYSEX * 1.0
BODYSEX SELF * 0.5
BODYSEX WANT * 0.5
BODYSEX TECH * -1.5
KILL YOU > 2.8
KILL YOU >> 0.9
KILL YOU < 1.4
KILL YOU << 0.6
KILL WANT * 0.8
KILL SELF < 0.5
KILL BODY * 0.6
KILL HOME * 0.8
KILL GRP * 1.8
KILL THEM * 0.7
KILL TECH * -3.0
KILL NICE * -0.8
WPN YOU * 1.6
WPN HOME * 0.8
WPN SELF * 0.6
WPN TECH * -1.5
HATE YOU * 2.4
HATE GRP * 1.6
HATE THEM * 1.6
HATE ADJ * 0.5
HATE TECH * -1.5
TERM YOU * 0.8
TERM TALK * -1.5
"""
