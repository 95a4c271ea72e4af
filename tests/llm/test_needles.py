"""The needles let every branch of the grammars through."""

import pytest

from quillmesh.llm import residue as R

EXAMPLES = [
    "Verify you are human", "Please note. Verify that you are robot", "You don't have access to this page.", "You do not have permission to view", "410 Gone", "301", "Connection refused", "Connection timed out",
    "This page has been removed.", "The file has moved or no longer exists", "Code404", "code  503", "HTTP status 404", "Error: 500", "404 Not Found", "403 Forbidden", "Something went wrong.", "Whoops!", "We're sorry,",
    "Your session has expired", "You are blocked", "You have reached your limit", "Checking your browser", "Solve the puzzle now", "Sign in to continue", "The site is closed for maintenance",
    "This book is not offered in your country", "Seite nicht gefunden", "Zugriff gesperrt", "Der Server antwortet nicht", "Page introuvable", "Accès interdit", "Página no disponible", "Acceso denegado", "Su sesión ha caducado",
    "Description is missing", "Text is here", "Summary missing", "Chapter coming soon", "Your text here", "Insert the summary below", "Review not yet written", "Dummy text only", "NA", "N/A", "TBD", "TODO: abstract",
    "Beschreibung folgt", "Hier steht der Text", "Blindtext", "Résumé à venir", "Placez le texte", "Insérez votre résumé", "Insérer une description", "Ici la critique", "Aquí va el texto", "Inserte su título", "Texto pendiente",
    "nostrud laboris sint sunt culpa", "Scripts are disabled", "Script is required", "JS is required", "Allow js.", "Please enable cookies", "Without scripting, the page cannot be shown", "This page requires javascript",
    "Bitte aktivieren Sie Skripte", "Veuillez activer les scripts", "Por favor, active los scripts", "Written undefined", "Published null", "Author: undefined", "null ratings", "Stack trace:", "java.lang.FooException: x",
    "{{name}}", "${name}", "<%= x %>", "[[insert name]]", "@@name@@", "%NAME%", "__NAME__", "<<name>>", "#name#", "{name}", "[NAME]", "<!-- include x -->", "Dear [Name]",
]


@pytest.mark.parametrize("text", EXAMPLES)
def test_gated_equals_ungated(text):
    parts = [text, *R._SENTENCE.split(text)]
    ungated = next((k for p in parts if (k := R._kind_of(p, set(R._NEEDLES)))), None)
    assert R.residue_kind(text) == ungated
    assert (ungated is None) == (text == "301")
