from __future__ import annotations

import pytest

from gridloom.llm.html_text import visible_text


@pytest.mark.parametrize(
    "page, want",
    [
        ("<style>@media print{.x{display:none}}</style><p class=x>yes", "yes"),
        ("<style>@media (max-width: 600px){.x{display:none} p{color:red}} .y{display:none}</style><i class=x>yes</i><i class=y>no</i>", "yes"),
        ("<style>@media screen{.x{display:none}}</style><p class=x>no</p>yes", "yes"),
        ("<style>@import 'a'; @font-face{src:url(x)} .x{display:none}</style><p class=x>no</p>yes", "yes"),
        ("<style media=print>.x{display:none}</style><p class=x>yes", "yes"),
        ("<style>/* .x{display:none} */</style><p class=x>yes", "yes"),
        ("<style>.x{display:none} .x{display:block}</style><p class=x>yes", "yes"),
        ("<div>a<svg/>b<math/>c</div>d", "abc\nd"), ("<div><svg width='1' />b</div>", "b"),
        ("<svg><title/><g hidden/><text>a</text><text>b</text></svg>c", "a\nb\nc"),
        ("<svg><defs><text>no</text></defs><title>no</title><a>yes</a></svg>", "yes"),
        ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>no</annotation></math>", "x=1"),
        ("<svg><foreignObject>a<br/>b</foreignObject></svg>", "a\nb"),
        ("<svg><defs>no<p>yes", "yes"), ("<i/>a", "a"),
        ("<div style='visibility:hidden'>no<b style='visibility:visible'>yes</b>no</div>", "yes"),
        ("<style>.h{visibility:hidden}.v{visibility:visible}</style><ul class=h><li>no<li class=v>yes</ul>", "• yes"),
        ("<div style='display:none'>no<b style='visibility:visible'>no</b></div>yes", "yes"),
    ],
)
def test_shown(page, want):
    assert visible_text(page) == want
