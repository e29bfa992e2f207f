"""Function words of the languages handled, as common in public stop-word lists."""

from __future__ import annotations

FUNCTION_WORDS = {
    "en": """the of and in to a is that for it as was with be by on not he his but at are this have from or had an they
    which one you were all her she there would their we him been has when who will no more if out so up said what its
    about than into them can only other time some could these two may first then do any like my now over such our me
    even most made after also did many off before must well back through where much your way down should because each
    just those people how too little very make still see own both under i upon whether without between among within
    during while against despite therefore neither nor although yet once across per than""".split(),
    "de": """der die das und in zu den von ist des sich mit dem dass er es ein ich auf so eine auch als an nach wie im
    für man aber aus durch wenn nur war noch werden bei hat wir was wird sein einen welche sind oder zur um haben einer
    mir über ihm diese einem ihr uns da zum kann doch vor dieser mich ihn du hatte seine mehr am denn nun unter sehr
    selbst schon hier bis habe ihre dann ihnen seiner alle wieder meine gegen vom ganz wo muss ohne eines können sei
    nicht kein keine weder eher ob sobald sollten durften ließ unserer bislang""".split(),
    "fr": """le la les de des du un une et en à au aux que qui dans pour par sur ne pas ce cette ces il elle nous vous
    ils est sont a ont été plus ou où se sa son ses leur avec si mais dont y d l n s c j qu entre aucun rien dès lors
    sans sous très tout toute tous être serait comme fait même aussi selon plusieurs il reste avons chez ici""".split(),
    "es": """el la los las de del un una y en a al que se no por con para su sus es son lo como más o pero le ha hay
    este esta estos estas si ya entre cuando muy sin sobre también me hasta donde quien desde todo nos durante todos
    uno les ni contra otros ese eso ante ellos e esto antes algunos yo otro otras otra él tanto esa mucho nada según
    sería una ninguna bajo ahora varias cada""".split(),
}
SETS = {k: frozenset(v) for k, v in FUNCTION_WORDS.items()}
ANY = frozenset().union(*SETS.values())
